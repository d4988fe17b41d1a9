"""Workflow records: stages and gates, jobs, sweeps, reviews, required artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that are sent to all tasks at most.
FEW = 10_000


def latest(log: DataFrame, keys: list[str], at: str, *tie: str) -> DataFrame:
    """The last record of each key, by time and then by the tie columns."""
    order = [F.col(c).desc() for c in (at, *tie)]
    return log.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def _few(rows: DataFrame) -> DataFrame:
    """Rows to send to all tasks, counted first."""
    if rows.limit(FEW + 1).count() > FEW:
        raise ValueError(f"more than {FEW} rows")
    return F.broadcast(rows)


def gate(states: DataFrame, needs: DataFrame, dry_run: bool = False) -> DataFrame:
    """states (project, stage, status), needs (stage, requires) -> (project, stage, open): a stage
    may run once all it requires are completed (or, in a dry run, planned)."""
    done = ["completed", "planned"] if dry_run else ["completed"]
    projects = states.select("project").distinct()
    asked = projects.join(_few(needs))
    got = states.select("project", F.col("stage").alias("requires"), "status")
    both = asked.join(got, ["project", "requires"], "left")
    return both.groupBy("project", "stage").agg(F.bool_and(F.coalesce(F.col("status").isin(*done), F.lit(False))).alias("open"))


def missing_and_extra(expected: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """(key, state): what is expected and not given, and the reverse."""
    a, b = expected.select(key).distinct(), given.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("state", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("state", F.lit("extra")))


def review(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """(candidate_id) and (candidate_id, decision) -> (candidate_id, state): accept, reject,
    missing (proposed and not decided), extra (decided and not proposed), or duplicate."""
    d = decisions.groupBy("candidate_id").agg(F.count("*").alias("n"), F.max("decision").alias("decision"))
    both = proposals.select("candidate_id", F.lit(1).alias("proposed")).join(d, "candidate_id", "full_outer")
    state = F.when(F.col("proposed").isNull(), "extra").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise(F.col("decision"))
    return both.select("candidate_id", state.alias("state"))


def finalize(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """The decisions, if each proposal has exactly one and a rejection its reason; else an error."""
    open_ = review(proposals, decisions).filter(~F.col("state").isin("accept", "reject"))
    if "reason" in decisions.columns:
        open_ = open_.unionByName(decisions.filter((F.col("decision") == "reject") & (F.coalesce(F.trim("reason"), F.lit("")) == "")).select("candidate_id", F.lit("reason").alias("state")))
    found = open_.limit(5).collect()
    if found:
        raise ValueError("the review is not complete: " + ", ".join(f"{r.candidate_id} {r.state}" for r in found))
    return proposals.select("candidate_id").join(decisions, "candidate_id")


def required(rules: DataFrame, present: DataFrame) -> DataFrame:
    """(stage, artifact) that no row of ``present`` has."""
    return rules.join(present.select("stage", "artifact").distinct(), ["stage", "artifact"], "left_anti")


def sweep(bases: DataFrame, values: DataFrame, name: Column, output: Column) -> DataFrame:
    """One job for each base and value of a sweep; more than ``FEW`` values are an error."""
    return bases.join(_few(values)).withColumn("job", name).withColumn("output", output)


def chosen(sweep_results: DataFrame, picks: DataFrame, within: float = 1e-12) -> DataFrame:
    """Sweep rows whose beta a pick names, within rounding: a pick goes to its step of that width and to
    the ones beside it, a row to its own."""
    step = lambda b: F.rint(b / within / 4)
    near = picks.select("beta", F.explode(F.array(*[step(F.col("beta")) + d for d in (-1, 0, 1)])).alias("k"))
    rows = sweep_results.withColumn("__k", step(F.col("beta"))).alias("s")
    hit = (F.col("s.__k") == F.col("p.k")) & (F.abs(F.col("s.beta") - F.col("p.beta")) <= within)
    return rows.join(near.alias("p"), hit, "left_semi").drop("__k")


def checks(rows: DataFrame) -> DataFrame:
    """(subject, check, ok) -> (subject, passed, failed checks in order)."""
    return rows.groupBy("subject").agg(F.bool_and("ok").alias("passed"), F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("check")))).alias("failed"))


def evidence(metrics: DataFrame) -> DataFrame:
    """Ranks only where there is ground truth; approval is never part of metrics."""
    rank = F.row_number().over(W.partitionBy("project").orderBy(F.col("score").desc_nulls_last(), "name"))
    return metrics.withColumn("rank", F.when(F.col("has_truth"), rank)).withColumn("approval", F.lit("withheld"))


def layer_issues(layers: DataFrame, raw: DataFrame) -> DataFrame:
    """Layers (specimen, layer, extent, origin) that differ from their specimen's raw data."""
    r = raw.select("specimen", F.col("extent").alias("raw_extent"), F.col("origin").alias("raw_origin"))
    both = layers.join(r, "specimen")
    issue = F.when(F.col("extent") != F.col("raw_extent"), "extent").when(F.col("origin") != F.col("raw_origin"), "origin")
    return both.withColumn("issue", issue).filter("issue IS NOT NULL")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that stand more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def same_set(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, same: whether two tables hold the same rows, repeats aside."""
    apart = left.subtract(right).limit(1).unionByName(right.subtract(left).limit(1))
    return apart.agg((F.count("*") == 0).alias("same"))


def warnings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, warnings): the distinct texts of each key in order."""
    return rows.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(text)), "; ").alias("warnings"))


def reads(layers: DataFrame) -> DataFrame:
    """(dataset, roles): every dataset once, however many layers show it."""
    return layers.groupBy("dataset").agg(F.count("*").alias("roles"))


def verified_projects(projects: DataFrame, artifacts: DataFrame, declared: list[str]) -> DataFrame:
    """(project, passed, missing): artifacts (project, uri, present) all there unless remote, every
    declared check true, the pilot approved, no severe issue, reconciliation complete where blocks
    need it, and every output named."""
    from voxelspark.functions.scalars import is_remote

    gone = artifacts.filter(~F.coalesce("present", F.lit(False)) & ~is_remote(F.col("uri"))).groupBy("project").agg(F.count("*").alias("missing"))
    both = projects.join(gone, "project", "left").fillna(0, ["missing"])
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    ok = (F.col("missing") == 0) & yes("pilot_approved") & F.coalesce(F.col("severe_issues") == 0, F.lit(False))
    for c in declared:
        ok = ok & yes(c)
    ok = ok & ((F.col("scope") != "per-block") | yes("reconciled")) & F.forall("outputs", lambda u: F.coalesce(F.length(u) > 0, F.lit(False)))
    return both.select("project", ok.alias("passed"), "missing")


def deliveries(projects: DataFrame, verified: DataFrame) -> DataFrame:
    """(project, status, manifest): a JSON manifest of each project that passed; the others are
    withheld and have none."""
    both = projects.join(verified, "project", "left")
    passed = F.coalesce(F.col("passed"), F.lit(False))
    manifest = F.to_json(F.struct("project", F.col("digest").alias("config_sha256"), F.lit("finalized").alias("status")))
    return both.select("project", F.when(passed, "finalized").otherwise("withheld").alias("status"), F.when(passed, manifest).alias("manifest"))


def bound_selections(selections: DataFrame, candidates: DataFrame, configs: DataFrame, within: float = 1e-12) -> DataFrame:
    """(project, state) of selections (project, beta, digest): stale if the configuration's digest is
    another, unknown if no candidate (project, beta, complete) has that beta within rounding,
    incomplete if its outputs are not all there, else bound."""
    key = lambda b: F.rint(b / within / 4)
    near = candidates.select("project", F.col("beta").alias("found"), "complete", F.explode(F.array(*[key(F.col("beta")) + d for d in (-1, 0, 1)])).alias("k"))
    s = selections.join(configs.select("project", F.col("digest").alias("current")), "project", "left").withColumn("k", key(F.col("beta")))
    both = s.join(near, ["project", "k"], "left").withColumn("hit", F.abs(F.col("found") - F.col("beta")) <= within)
    per = both.groupBy("project", "beta", "digest", "current").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("known"), F.coalesce(F.bool_or(F.col("hit") & F.col("complete")), F.lit(False)).alias("complete"))
    state = F.when(~F.col("digest").eqNullSafe(F.col("current")), "stale").when(~F.col("known"), "unknown").when(~F.col("complete"), "incomplete").otherwise("bound")
    return per.select("project", state.alias("state"))


def approvals(reports: DataFrame, decisions: DataFrame) -> DataFrame:
    """(name, state): a decision counts beside its report, whose own approval must be withheld; without
    a reviewer or for a report that approves itself it is refused."""
    both = reports.join(decisions, "name", "left")
    state = (
        F.when(F.col("approval") != "withheld", "refused").when(F.col("decision").isNull(), "open")
        .when(F.coalesce(F.trim("reviewer"), F.lit("")) == "", "refused").otherwise(F.col("decision"))
    )
    return both.select("name", state.alias("state"))


def render_checks(renders: DataFrame, width: int, height: int, fps: float, drift: float = 0.15) -> DataFrame:
    """(name, passed, failed): size, rate, frame count, hash and the drift of still holds."""
    rules = {
        "size": (F.col("width") == width) & (F.col("height") == height), "fps": F.abs(F.col("fps") - fps) < 1e-6,
        "frames": F.col("frames") == F.col("expected_frames"), "hash": F.col("sha256").rlike("^[0-9a-f]{64}$"), "drift": F.col("drift_px") <= drift,
    }
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return renders.select("name", (F.size(failed) == 0).alias("passed"), F.array_join(failed, ",").alias("failed"))


def audit(datasets: DataFrame) -> DataFrame:
    """(specimen, datasets, issues, bytes) of datasets (specimen, role, dataset, extent, origin, bytes):
    each one read once, and those counted that lie elsewhere than the raw data."""
    raw = datasets.filter("role = 'raw'").groupBy("specimen").agg(F.min("extent").alias("raw_extent"), F.min("origin").alias("raw_origin"))
    once = datasets.groupBy("specimen", "dataset").agg(F.min("extent").alias("extent"), F.min("origin").alias("origin"), F.max("bytes").alias("bytes"))
    both = once.join(raw, "specimen", "left")
    apart = ~(F.col("extent").eqNullSafe(F.col("raw_extent")) & F.col("origin").eqNullSafe(F.col("raw_origin")))
    return both.groupBy("specimen").agg(F.count("*").alias("datasets"), F.count_if(apart).alias("issues"), F.sum("bytes").alias("bytes"))


def sources_agree(artifacts: DataFrame) -> DataFrame:
    """(artifact, state) of artifacts (artifact, source_id, bounds) against the source's own record,
    which is the one of kind ``source``: unknown, elsewhere or ok."""
    own = artifacts.filter("kind = 'source'").select("source_id", F.col("bounds").alias("own"))
    both = artifacts.filter("kind <> 'source'").join(own, "source_id", "left")
    state = F.when(F.col("own").isNull(), "unknown").when(~F.col("bounds").eqNullSafe(F.col("own")), "elsewhere").otherwise("ok")
    return both.select("artifact", state.alias("state"))


def as_of(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """Each left row with the right table's last value at or before it, by one sort of both tables and
    no join of times; among right rows of one time the largest value is the last."""
    both = left.withColumn("__v", F.lit(None).cast(dict(right.dtypes)[value])).withColumn("__left", F.lit(1))
    rest = [F.lit(None).cast(t).alias(c) for c, t in left.dtypes if c not in (by, at)]
    other = right.select(by, at, *rest, F.col(value).alias("__v"), F.lit(0).alias("__left"))
    w = W.partitionBy(by).orderBy(at, "__left", "__v").rowsBetween(W.unboundedPreceding, 0)
    return both.unionByName(other).withColumn(value, F.last("__v", ignorenulls=True).over(w)).filter("__left = 1").drop("__v", "__left")


def grid_compatible(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """(id, state) of datasets (id, kind, dtype, channels, scale) to be written: new, same grid, or
    another grid, which may not be replaced."""
    same = F.lit(True)
    for c in ("kind", "dtype", "channels", "scale"):
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"e.{c}"))
    both = wanted.alias("w").join(existing.alias("e"), F.col("w.id") == F.col("e.id"), "left")
    return both.select(F.col("w.id").alias("id"), F.when(F.col("e.id").isNull(), "new").when(same, "same").otherwise("differs").alias("state"))


def executed(argv: list[str], outputs: list[str], folder: str, allow_overwrite: bool = False) -> dict:
    """Runs a planned command on the driver, without a shell: refuses outputs that exist, keeps what it
    prints in ``folder``, and is completed only if it ends well and every output is there."""
    import datetime
    import os
    import subprocess

    from voxelspark.sources.documents import write

    there = [o for o in outputs if os.path.exists(o)]
    if there and not allow_overwrite:
        raise FileExistsError(", ".join(there))
    os.makedirs(folder, exist_ok=True)
    now = lambda: datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    began, done = now(), subprocess.run(argv, capture_output=True, text=True, errors="replace", check=False)
    for name, text in (("stdout.txt", done.stdout), ("stderr.txt", done.stderr)):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    missing = [o for o in outputs if not os.path.exists(o)]
    record = {"argv": argv, "started_at": began, "completed_at": now(), "returncode": done.returncode, "missing": missing, "status": "failed" if done.returncode or missing else "completed"}
    write(os.path.join(folder, "run.json"), record, overwrite=True)
    if record["status"] == "failed":
        raise RuntimeError(f"the command ended with {done.returncode}; missing: {missing}")
    return record
