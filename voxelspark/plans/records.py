"""Registered queries over settings, workflow records, events and scalars, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark import views
from voxelspark.functions import scalars as S
from voxelspark.operators import camera, constraints, workflow
from voxelspark.plans.registry import query
from voxelspark.sources import documents
from voxelspark.streaming import stages

# Rules ---------------------------------------------------------------------------------------------
# Every part stands for a project.  All settings are sound but for the one that its number picks, so
# the SQL counterpart is the list of what each breach must be called.


def _breaches(spark: SparkSession, sf_dir: str, sound: dict[str, str], broken: list[tuple]) -> DataFrame:
    """Settings as columns; ``broken`` are (column, unsound value, names of the broken rules)."""
    part = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    columns = []
    for name, value in sound.items():
        cases = " ".join(f"WHEN {i} THEN {bad}" for i, (column, bad, *_) in enumerate(broken) if column == name)
        columns.append(F.expr(f"CASE id % {len(broken) + 1} {cases} ELSE {value} END" if cases else value).alias(name))
    return part.select("id", *columns)


def _named(broken: list[tuple]) -> str:
    rows = ", ".join(f"({i}, '{rule}')" for i, (_, _, *rules) in enumerate(broken) for rule in rules)
    return f"SELECT p_partkey AS id, rule FROM part JOIN (VALUES {rows}) v(i, rule) ON p_partkey % {len(broken) + 1} = i"


_HASH = "repeat('ab', 32)"
_NEURON = {
    "project_id": "'p-1'", "source_uri": "'/data/raw'", "source_format": "'zarr'", "axis_order": "'ZYX'", "shape": "array(25, 260, 270)", "resolution": "array(40.0D, 8.0D, 8.0D)",
    "offset": "array(10, 20, -30)", "bbox": "array(0, 0, 0, 25, 260, 270)", "read_only": "true", "identity": "'raw-1'", "repository": "'repo'", "commit": "'0123abc'", "checkpoint": "'c.pth'",
    "checkpoint_sha256": _HASH, "target": "array(40.0D, 8.0D, 8.0D)", "xy_range": "array(6.0D, 12.0D)", "z_policy": "'preserve'", "normalization": "'zscore'", "patch": "array(20, 128, 128)",
    "halo": "array(4, 16, 16)", "core": "array(12, 96, 96)", "max_end_error": "20.4D", "pilot_rois": "array(array(0, 0, 0, 8, 64, 64))", "scope": "'per-block'", "label_dtype": "'uint64'",
    "background": "0", "reconciliation": "true", "betas": "array(0.1D, 0.25D)", "output": "'/out/p-1'", "argv": "array('run', '{beta}', '{selected_beta}')", "env_keys": "array('CUDA_VISIBLE_DEVICES')",
}
_NEURON_BROKEN = [
    ("project_id", "'a b'", "project_id"), ("project_id", "CAST(NULL AS STRING)", "project_id"), ("source_uri", "' '", "source_uri"), ("source_format", "''", "source_format"), ("axis_order", "'zyy'", "axis_order"),
    ("shape", "array(25, 0, 270)", "shape", "bbox", "pilot_rois"), ("resolution", "array(40.0D, 8.0D)", "resolution"), ("offset", "array(1, 2)", "offset"), ("bbox", "array(0, 0, 0, 26, 260, 270)", "bbox"),
    ("bbox", "array(5, 0, 0, 5, 260, 270)", "bbox"), ("read_only", "false", "read_only"), ("identity", "''", "identity"), ("repository", "''", "repository"), ("commit", "'main'", "commit_pinned"),
    ("commit", "'0123abz'", "commit_pinned"), ("checkpoint", "''", "checkpoint"), ("checkpoint_sha256", "'abc'", "checkpoint_sha256"), ("target", "array(40.0D, 8.0D, 14.0D)", "target_in_range"),
    ("target", "array(50.0D, 8.0D, 8.0D)", "z_preserved"), ("xy_range", "array(12.0D, 6.0D)", "xy_range", "target_in_range"), ("z_policy", "'keep'", "z_policy"), ("normalization", "''", "normalization"),
    ("halo", "array(4, 64, 16)", "halo_under_half"), ("halo", "array(-1, 16, 16)", "halo"), ("core", "array(21, 96, 96)", "core_in_patch"), ("patch", "array(20, 0, 128)", "patch", "halo_under_half", "core_in_patch"),
    ("max_end_error", "-1.0D", "max_end_error"), ("pilot_rois", "CAST(array() AS ARRAY<ARRAY<INT>>)", "pilot_rois"), ("pilot_rois", "array(array(0, 0, 0, 8, 64, 640))", "pilot_rois"), ("scope", "'tile'", "scope"),
    ("label_dtype", "'int32'", "label_dtype"), ("background", "1", "background"), ("reconciliation", "false", "reconciliation"), ("betas", "array(0.1D)", "betas"), ("betas", "array(0.1D, 1.0D)", "betas"),
    ("betas", "array(0.1D, 0.1D)", "betas_unique"), ("output", "'/data/raw/out'", "output_apart"), ("output", "'/data/raw/'", "output_apart"), ("argv", "array('{beta}', '', '{selected_beta}')", "argv"), ("argv", "array('run', '{beta}')", "sweep_placeholders"),
    ("env_keys", "array('HF_TOKEN')", "secrets"), ("env_keys", "array('my_access_key')", "secrets"),
]


@query(_named(_NEURON_BROKEN))
def rules_neuron(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(_breaches(spark, sf_dir, _NEURON, _NEURON_BROKEN), constraints.neuron_rules(), "id")


_MITO = {
    "project_id": "'m.1'", "axis_order": "'xyz'", "shape": "array(8, 64, 64)", "resolution": "array(40.0D, 8.0D, 8.0D)", "bbox": "array(0, 0, 0, 8, 64, 64)", "read_only": "true", "commit": "repeat('0a', 20)",
    "variant": "'MitoNet_v1'", "target": "array(40.0D, 16.0D, 16.0D)", "z_policy": "'preserve'", "checkpoint_sha256": _HASH, "model_config_sha256": _HASH, "profile": "'stack-16'", "mode": "'stack'",
    "orthoplane_reviewed": "false", "median_kernel": "3", "segmentation_confidence": "0.5D", "center_confidence": "0.1D", "merge_iou": "0.25D", "merge_ioa": "0.25D", "cluster_iou": "0.75D", "pixel_vote": "2",
    "center_min_distance": "3", "min_size_vox": "500", "min_span_slices": "4", "label_divisor": "20000", "downsample_factor": "2", "output": "'/out'", "source_uri": "'/raw'", "env_keys": "CAST(array() AS ARRAY<STRING>)",
}
_MITO_BROKEN = [
    ("project_id", "'-x'", "project_id"), ("axis_order", "'xy'", "axis_order"), ("shape", "array(8, 64)", "shape", "bbox"), ("resolution", "array(40.0D, -8.0D, 8.0D)", "resolution"), ("bbox", "array(0, 0, 0, 8, 64)", "bbox"),
    ("read_only", "CAST(NULL AS BOOLEAN)", "read_only"), ("commit", "'0a0a0a0'", "commit"), ("variant", "'other'", "variant"), ("target", "array(40.0D, 16.0D)", "target"), ("z_policy", "'drop'", "z_policy"),
    ("target", "array(80.0D, 16.0D, 16.0D)", "z_preserved"), ("checkpoint_sha256", "''", "checkpoint_sha256"), ("model_config_sha256", "repeat('g', 64)", "model_config_sha256"), ("profile", "'a/b'", "profile"),
    ("mode", "'volume'", "mode"), ("mode", "'orthoplane'", "anisotropy"), ("median_kernel", "4", "median_kernel"), ("segmentation_confidence", "1.5D", "segmentation_confidence"), ("center_confidence", "-0.1D", "center_confidence"),
    ("merge_iou", "CAST(NULL AS DOUBLE)", "merge_iou"), ("merge_ioa", "2.0D", "merge_ioa"), ("cluster_iou", "1.01D", "cluster_iou"), ("pixel_vote", "4", "pixel_vote"), ("center_min_distance", "0", "center_min_distance"),
    ("min_size_vox", "-5", "min_size_vox"), ("min_span_slices", "0", "min_span_slices"), ("label_divisor", "0", "label_divisor"), ("downsample_factor", "6", "downsample_factor"), ("output", "'/raw'", "output_apart"), ("env_keys", "array('db_password')", "secrets"),
]


@query(_named(_MITO_BROKEN))
def rules_mito(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(_breaches(spark, sf_dir, _MITO, _MITO_BROKEN), constraints.mito_rules(), "id")


_ADVISOR = {
    "axes": "'zyx'", "uri": "'/raw'", "shape": "array(2, 4, 8)", "voxel": "array(10.0D, 2.0D, 2.0D)", "patch": "array(1, 2, 2)", "stride": "array(1, 2, 2)", "boundary": "'valid'", "dimension": "3", "repository": "'r'",
    "commit": "'c'", "checkpoint_sha256": _HASH, "windows": "array('1x1x1', '1x1x2')", "max_items": "2", "budget": "32", "k": "3", "metric": "'euclidean'", "alpha": "1.0D", "guards": "array(array(1, 0, 0, 2, 4, 8))",
}
_ADVISOR_BROKEN = [
    ("axes", "'xyz'", "axes"), ("uri", "''", "uri"), ("shape", "array(2, 4)", "shape", "patch_in_shape", "guards"), ("voxel", "array(10.0D, 0.0D, 2.0D)", "voxel"), ("patch", "array(3, 2, 2)", "patch_in_shape"), ("stride", "array(0, 2, 2)", "stride"),
    ("boundary", "'wrap'", "boundary"), ("dimension", "0", "dimension"), ("repository", "' '", "repository"), ("commit", "CAST(NULL AS STRING)", "commit"), ("checkpoint_sha256", "repeat('a', 63)", "checkpoint_sha256"),
    ("windows", "CAST(array() AS ARRAY<STRING>)", "windows"), ("windows", "array('1x0x1')", "window_shapes"), ("windows", "array('1x1x1', '1x1x1')", "windows_unique"), ("max_items", "0", "max_items"), ("budget", "-1", "budget"),
    ("k", "0", "k"), ("metric", "'manhattan'", "metric"), ("alpha", "1.5D", "alpha"), ("guards", "array(array(1, 0, 0, 3, 4, 8))", "guards"), ("guards", "array(array(1, 0, 0, 1, 4, 8))", "guards"),
]


@query(_named(_ADVISOR_BROKEN))
def rules_advisor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(_breaches(spark, sf_dir, _ADVISOR, _ADVISOR_BROKEN), constraints.advisor_rules(), "id")


_PUBLISHED = {
    "output": "'a/labels'", "target": "'/root/a/labels'", "source": "'/data/x.npy'", "axes": "'zyx'", "layer_type": "'segmentation'", "resolution": "array(8.0D, 8.0D, 40.0D)", "offset": "array(10.0D, 0.0D, -3.0D)",
    "chunk": "array(64, 64, 16)", "encoding": "'compressed_segmentation'",
}
_PUBLISHED_BROKEN = [
    ("output", "''", "output"), ("output", "'/abs'", "output"), ("output", "'a/../../b'", "output"), ("output", "'..'", "output"), ("output", "'C:x'", "output"), ("source", "''", "source"), ("axes", "'zxy'", "axes"),
    ("target", "'/data/x.npy/out'", "output_apart"), ("target", "'/data/x.npy'", "output_apart"), ("layer_type", "'mesh'", "layer_type"), ("resolution", "array(8.0D, 0.0D, 40.0D)", "resolution"), ("offset", "array(1.0D, NULL, 2.0D)", "offset"),
    ("chunk", "array(64, 64)", "chunk"), ("encoding", "'png'", "encoding"), ("encoding", "'jpeg'", "categorical"),
]


@query(_named(_PUBLISHED_BROKEN))
def rules_precomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _breaches(spark, sf_dir, _PUBLISHED, _PUBLISHED_BROKEN).withColumn("key", F.col("id")).withColumn("id", F.col("key").cast("string"))
    return constraints.violations(rows, constraints.precomputed_rules(), "key").withColumnRenamed("key", "id")


_VIDEO = {
    "source_root": "'/in'", "output_root": "'/out'", **{f"{n}_seconds": "2.0D" for n in ("metadata", "isolated", "density", "all", "zoom", "hold", "move")}, "fps": "24", "width": "1920", "height": "1080", "easing": "'smootherstep'",
    "entry_fov": "1.4D", "hold_pan": "0.0D", "hold_zoom": "0.1D", "zoom_out": "0.35D", "rgb": "array(255, 0, 10)", "opacity": "CAST(NULL AS DOUBLE)", "roi": "array(0.0D, 5.0D, 1.0D, 9.0D)", "mode": "'seeded_random'", "count": "4", "seed": "7",
}
_VIDEO_BROKEN = [
    ("output_root", "'/in'", "roots"), *[(f"{n}_seconds", "-1.0D", f"{n}_seconds") for n in ("metadata", "isolated", "density", "all", "zoom", "hold", "move")], ("fps", "0", "frame"), ("easing", "'bounce'", "easing"), ("entry_fov", "0.9D", "entry_fov"),
    ("hold_pan", "0.25D", "hold_pan"), ("hold_zoom", "0.4D", "hold_zoom"), ("zoom_out", "1.1D", "zoom_out"), ("rgb", "array(256, 0, 0)", "colour"), ("rgb", "array(1, 2)", "colour"), ("opacity", "1.2D", "opacity"), ("roi", "array(5.0D, 0.0D, 1.0D, 9.0D)", "roi"),
    ("roi", "array(0.0D, 5.0D)", "roi"), ("mode", "'manual'", "mode"), ("count", "0", "count"), ("seed", "CAST(NULL AS INT)", "seed"),
]


@query(_named(_VIDEO_BROKEN))
def rules_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(_breaches(spark, sf_dir, _VIDEO, _VIDEO_BROKEN), constraints.video_rules(), "id")


_REVIEW = {
    "name": "concat('c', id % 3)", "kind": "'semantic'", "grid_id": "'g'", "raw_grid_id": "'g'", "provenance": "'hand'", "values": "1", "shape": "array(3, 16, 16)", "raw_shape": "array(3, 16, 16)", "threshold": "0.5D", "axis": "'xy'",
}
_REVIEW_BROKEN = [
    ("name", "' '", "name"), ("kind", "'panoptic'", "kind"), ("grid_id", "'h'", "grid"), ("provenance", "''", "provenance"), ("values", "2", "one_value"), ("shape", "array(3, 16)", "shape"), ("threshold", "0.0D", "threshold"), ("axis", "'zz'", "axis"),
]


@query(_named(_REVIEW_BROKEN))
def rules_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(_breaches(spark, sf_dir, _REVIEW, _REVIEW_BROKEN), constraints.review_rules(), "id")


@query("""WITH c AS (SELECT p_partkey // 4 AS review, 'n' || (p_partkey % 4 - CASE WHEN p_size % 5 = 0 AND p_partkey % 4 = 1 THEN 1 ELSE 0 END) AS name, CASE WHEN p_size % 7 = 0 THEN 'Instance' ELSE 'semantic' END AS kind FROM part)
SELECT review, 'duplicate_name' AS issue FROM c GROUP BY 1 HAVING count(DISTINCT name) < count(*) UNION ALL SELECT review, 'mixed_kinds' FROM c GROUP BY 1 HAVING count(DISTINCT kind) > 1""")
def review_table_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    place = k % 4 - F.when((n % 5 == 0) & (k % 4 == 1), 1).otherwise(0)
    c = views.table(spark, sf_dir, "part").select(F.floor(k / 4).alias("review"), F.concat(F.lit("n"), place.cast("string")).alias("name"), F.when(n % 7 == 0, "Instance").otherwise("semantic").alias("kind"))
    return constraints.review_table_issues(c)


# Scalars --------------------------------------------------------------------------------------------

_T = "(p_size - 5) / 40.0::DOUBLE"
_C = f"least(greatest({_T}, 0), 1)"


@query(f"""SELECT p_partkey AS id, round({_C}, 9) AS linear, round({_C} * {_C} * (3 - 2 * {_C}), 9) AS smoothstep, round({_C} * {_C} * {_C} * ({_C} * ({_C} * 6 - 15) + 10), 9) AS smootherstep,
  round(0.5 - 0.5 * cos(pi() * {_C}), 9) AS cosine, CAST(ceil(p_partkey / 7.0) AS BIGINT) AS parts FROM part""")
def easing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = (F.col("p_size") - 5) / 40.0
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), *[F.round(S.ease(u, k), 9).alias(k) for k in ("linear", "smoothstep", "smootherstep", "cosine")], S.ceil_div(F.col("p_partkey"), 7).alias("parts"))


_VALUES = ["p_retailprice / 1000", "(p_size - 25) / 8.0", "p_retailprice * 1000000", "(p_size - 20) / 80000.0", "p_partkey * 1.0"]


@query(f"""WITH x AS ({" UNION ALL ".join(f"SELECT p_partkey AS id, {i} AS kind, CAST({v.replace('.0', '.0::DOUBLE')} AS DOUBLE) AS x FROM part" for i, v in enumerate(_VALUES))})
SELECT id, kind, format('{{:.7g}}', x) AS short, replace(replace(format('{{:.12g}}', x), '.', 'p'), '-', 'm') AS tag FROM x""")
def number_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table is a small file, one task, but the texts are work for all.
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice").repartition(spark.sparkContext.defaultParallelism)
    n = part.select(F.col("p_partkey").alias("id"), F.posexplode(F.array(*[F.expr(v.replace(".0", ".0D")).cast("double") for v in _VALUES])).alias("kind", "x"))
    return n.select("id", "kind", S.short_number(F.col("x")).alias("short"), S.beta_tag(F.col("x")).alias("tag"))


@query("""WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url || '?k=1' WHEN 1 THEN replace(url, '://', '://me:pw@') WHEN 2 THEN replace(url, 'http', 'ftp') ELSE url END AS url FROM pages)
SELECT page_id, page_id % 5 NOT IN (1, 2) AND split_part(url, '#', 1) NOT LIKE '%?%' AS plain, url LIKE 'http%' AS remote FROM p""")
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, u = F.col("page_id") % 5, F.col("url")
    url = F.when(k == 0, F.concat(u, F.lit("?k=1"))).when(k == 1, F.replace(u, F.lit("://"), F.lit("://me:pw@"))).when(k == 2, F.replace(u, F.lit("http"), F.lit("ftp"))).otherwise(u)
    return views.table(spark, sf_dir, "pages").select("page_id", S.plain_url(url).alias("plain"), S.is_remote(url).alias("remote"))


@query("""WITH s AS (SELECT p_partkey AS id, p_size || ', ' || (p_partkey % 9) || ',' || CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE '2.5' END AS t, CASE p_partkey % 4 WHEN 0 THEN ' YES ' WHEN 1 THEN 'off' WHEN 2 THEN '1' ELSE 'maybe' END AS b FROM part)
SELECT id, CASE WHEN id % 5 = 0 OR id % 9 = 0 OR CAST(split_part(t, ',', 1) AS INT) <= 0 THEN NULL ELSE CAST(split_part(t, ',', 1) AS DOUBLE) + id % 9 + 2.5 END AS total, CASE id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag FROM s""")
def parsed_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = F.concat(F.col("p_size").cast("string"), F.lit(", "), (k % 9).cast("string"), F.lit(","), F.when(k % 5 == 0, "x").otherwise("2.5"))
    flag = F.when(k % 4 == 0, " YES ").when(k % 4 == 1, "off").when(k % 4 == 2, "1").otherwise("maybe")
    total = F.aggregate(S.triplet(text), F.lit(0.0), lambda a, v: a + v)
    return views.table(spark, sf_dir, "part").select(k.alias("id"), total.alias("total"), S.truth(flag).alias("flag"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'b,d' WHEN p_size % 3 = 1 THEN 'a,d' ELSE 'd' END AS missing, CASE WHEN p_size % 3 = 1 THEN '0' ELSE '1' END AS a, CASE WHEN p_size % 3 = 0 THEN '0' ELSE '2' END AS b FROM part""")
def settings_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 3
    m = lambda *kv: F.create_map(*map(F.lit, kv))
    given = F.when(n == 0, m("a", "1", "c", "3")).when(n == 1, m("b", "2", "c", "3")).otherwise(m("a", "1", "b", "2", "c", "3"))
    both = S.overlaid(m("a", "0", "b", "0", "d", "0"), given)
    return views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array_join(S.missing_keys(given, ["a", "b", "d"]), ",").alias("missing"), F.element_at(both, "a").alias("a"), F.element_at(both, "b").alias("b"))


@query("SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS run FROM events")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select("event_id", S.run_id(F.col("ts")).alias("run"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'run --part ' || p_partkey || ' --brand ' || p_brand END AS command, printf('#%02x%02x%02x', p_size * 5, CAST(p_partkey % 256 AS INT), 7) AS colour FROM part""")
def rendered_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    template = F.concat(F.lit("run --part {id} --brand {brand}"), F.when(n % 4 == 0, " {mode}").otherwise(""))
    return views.table(spark, sf_dir, "part").select(k.alias("id"), S.filled_in(template, {"id": k.cast("string"), "brand": F.col("p_brand")}).alias("command"), S.hex_colour(n * 5, (k % 256).cast("int"), F.lit(7)).alias("colour"))


@query("SELECT doc_id, sha256(coalesce(text, '')) || '  doc-' || doc_id AS line FROM documents")
def checksum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = views.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    named = documents.checksum_lines(d.select("path", "sha256"))
    return named.select(F.substring("path", 5, 30).cast("long").alias("doc_id"), F.col("value").alias("line"))


# Workflow -------------------------------------------------------------------------------------------


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.duplicates(views.table(spark, sf_dir, "part").select(F.col("p_name").alias("name")), "name")


@query("SELECT 'brands' AS pair, true AS same UNION ALL SELECT 'labels', NOT EXISTS (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) AND NOT EXISTS (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part").select("p_brand")
    brands = workflow.same_set(p, p.union(p)).select(F.lit("brands").alias("pair"), "same")
    docs = workflow.same_set(views.table(spark, sf_dir, "documents").select("doc_id"), views.table(spark, sf_dir, "labels").select("doc_id"))
    return brands.unionByName(docs.select(F.lit("labels").alias("pair"), "same"))


@query("SELECT user_id, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS warnings FROM events GROUP BY 1")
def sorted_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.warnings(views.table(spark, sf_dir, "events"), "user_id", "event_type")


@query("SELECT p_type AS dataset, count(*) AS roles FROM part GROUP BY 1")
def distinct_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.reads(views.table(spark, sf_dir, "part").select(F.col("p_type").alias("dataset")))


_PROJECTS = "SELECT o_orderkey AS project, o_orderkey % 11 <> 0 AS pilot_approved, CASE WHEN o_orderkey % 13 = 0 THEN 2 WHEN o_orderkey % 17 = 0 THEN NULL ELSE 0 END AS severe_issues, o_orderkey % 7 <> 0 AS bounds_match, CASE WHEN o_orderkey % 2 = 0 THEN 'per-block' ELSE 'whole-volume' END AS scope, o_orderkey % 6 <> 0 AS reconciled, CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE 'a' END AS uri FROM orders"
_ARTIFACTS = "SELECT l_orderkey AS project, CASE WHEN l_linenumber = 3 THEN 's3://b/x' ELSE 'x.json' END AS uri, l_discount < 0.1 AS present FROM lineitem"
_VERIFIED = f"""WITH p AS ({_PROJECTS}), a AS (SELECT project, count(*) AS missing FROM ({_ARTIFACTS}) t WHERE NOT present AND uri NOT LIKE 's3:%' GROUP BY 1)
SELECT project, coalesce(missing, 0) AS missing, coalesce(missing, 0) = 0 AND pilot_approved AND coalesce(severe_issues = 0, false) AND bounds_match AND (scope <> 'per-block' OR reconciled) AND uri <> '' AS passed FROM p LEFT JOIN a USING (project)"""


def _projects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    p = views.table(spark, sf_dir, "orders").select(
        k.alias("project"), (k % 11 != 0).alias("pilot_approved"), F.when(k % 13 == 0, 2).when(k % 17 == 0, None).otherwise(0).alias("severe_issues"), (k % 7 != 0).alias("bounds_match"),
        F.when(k % 2 == 0, "per-block").otherwise("whole-volume").alias("scope"), (k % 6 != 0).alias("reconciled"), F.array(F.when(k % 19 == 0, "").otherwise("a")).alias("outputs"), F.sha2(k.cast("string"), 256).alias("digest"),
    )
    a = views.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("project"), F.when(F.col("l_linenumber") == 3, "s3://b/x").otherwise("x.json").alias("uri"), (F.col("l_discount") < 0.1).alias("present"))
    return p, a


@query(_VERIFIED)
def verified_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.verified_projects(*_projects(spark, sf_dir), ["bounds_match"])


@query(f"""SELECT project, CASE WHEN passed THEN 'finalized' ELSE 'withheld' END AS status, CASE WHEN passed THEN '{{"project":' || project || ',"config_sha256":"' || sha256(project::VARCHAR) || '","status":"finalized"}}' END AS manifest FROM ({_VERIFIED}) v""")
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, a = _projects(spark, sf_dir)
    return workflow.deliveries(p.select("project", "digest"), workflow.verified_projects(p, a, ["bounds_match"]))


@query("""SELECT p_partkey AS project, CASE WHEN p_partkey % 5 = 0 THEN 'stale' WHEN p_partkey % 3 = 0 THEN 'unknown' WHEN p_partkey % 7 = 0 THEN 'incomplete' ELSE 'bound' END AS state FROM part""")
def bound_selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey"), views.table(spark, sf_dir, "part")
    s = p.select(k.alias("project"), F.when(k % 3 == 0, 0.4).otherwise(0.1 + 0.2).alias("beta"), F.when(k % 5 == 0, "old").otherwise("new").alias("digest"))
    c = p.select(k.alias("project"), F.lit(0.3).alias("beta"), (k % 7 != 0).alias("complete"))
    return workflow.bound_selections(s, c, p.select(k.alias("project"), F.lit("new").alias("digest")))


@query("""SELECT p_partkey AS name, CASE WHEN p_partkey % 6 = 0 THEN 'refused' WHEN p_partkey % 4 = 1 THEN 'open' WHEN p_partkey % 5 = 0 THEN 'refused' WHEN p_size % 2 = 0 THEN 'approved' ELSE 'rejected' END AS state FROM part""")
def approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey"), views.table(spark, sf_dir, "part")
    reports = p.select(k.alias("name"), F.when(k % 6 == 0, "approved").otherwise("withheld").alias("approval"))
    made = p.filter(k % 4 != 1).select(k.alias("name"), F.when(k % 5 == 0, " ").otherwise("ann").alias("reviewer"), F.when(F.col("p_size") % 2 == 0, "approved").otherwise("rejected").alias("decision"))
    return workflow.approvals(reports, made)


@query("""WITH r AS (SELECT p_partkey AS name, concat_ws(',', CASE WHEN p_size % 9 = 0 THEN 'size' END, CASE WHEN p_size % 11 = 0 THEN 'fps' END, CASE WHEN p_partkey % 8 = 0 THEN 'frames' END, CASE WHEN p_partkey % 13 = 0 THEN 'hash' END, CASE WHEN p_size % 10 > 7 THEN 'drift' END) AS failed FROM part)
SELECT name, failed = '' AS passed, failed FROM r""")
def render_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    r = views.table(spark, sf_dir, "part").select(
        k.alias("name"), F.when(n % 9 == 0, 1280).otherwise(1920).alias("width"), F.lit(1080).alias("height"), F.when(n % 11 == 0, 25.0).otherwise(24.0).alias("fps"), F.when(k % 8 == 0, 911).otherwise(912).alias("frames"),
        F.lit(912).alias("expected_frames"), F.when(k % 13 == 0, None).otherwise(F.sha2(k.cast("string"), 256)).alias("sha256"), (n % 10 / 50.0).alias("drift_px"),
    )
    return workflow.render_checks(r, 1920, 1080, 24.0)


_LAYERS = "SELECT p_partkey // 5 AS specimen, CASE WHEN p_partkey % 5 = 0 THEN 'raw' ELSE 'layer' END AS role, 'd' || (p_partkey // 5 * 5 + p_partkey % 5 - CASE WHEN p_partkey % 5 = 4 THEN 1 ELSE 0 END) AS dataset, CASE WHEN p_partkey % 7 = 1 THEN 90 ELSE 100 END AS extent, CASE WHEN p_partkey % 11 = 2 THEN 5 ELSE 0 END AS origin, CAST(p_size AS BIGINT) AS bytes FROM part"


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(F.lit("d"), (F.floor(k / 5) * 5 + k % 5 - F.when(k % 5 == 4, 1).otherwise(0)).cast("string"))
    return views.table(spark, sf_dir, "part").select(
        F.floor(k / 5).alias("specimen"), F.when(k % 5 == 0, "raw").otherwise("layer").alias("role"), name.alias("dataset"), F.when(k % 7 == 1, 90).otherwise(100).alias("extent"), F.when(k % 11 == 2, 5).otherwise(0).alias("origin"), F.col("p_size").cast("long").alias("bytes")
    )


@query(f"""WITH l AS ({_LAYERS}), r AS (SELECT specimen, min(extent) AS e, min(origin) AS o FROM l WHERE role = 'raw' GROUP BY 1), d AS (SELECT specimen, dataset, min(extent) AS extent, min(origin) AS origin, max(bytes) AS bytes FROM l GROUP BY 1, 2)
SELECT specimen, count(*) AS datasets, count(*) FILTER (WHERE extent IS DISTINCT FROM e OR origin IS DISTINCT FROM o) AS issues, CAST(sum(bytes) AS BIGINT) AS bytes FROM d LEFT JOIN r USING (specimen) GROUP BY 1""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.audit(_layers(spark, sf_dir))


@query(f"""WITH l AS ({_LAYERS}), r AS (SELECT specimen, extent AS e, origin AS o FROM l WHERE role = 'raw')
SELECT specimen, dataset, CASE WHEN extent <> e THEN 'extent' ELSE 'origin' END AS issue FROM l JOIN r USING (specimen) WHERE extent <> e OR origin <> o""")
def layer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _layers(spark, sf_dir)
    return workflow.layer_issues(d, d.filter("role = 'raw'")).select("specimen", "dataset", "issue")


@query("""WITH a AS (SELECT p_partkey AS artifact, p_partkey // 3 AS source_id, [0, 10 + CASE WHEN p_partkey % 8 = 5 THEN 1 ELSE 0 END] AS bounds, p_partkey % 3 = 0 AND p_partkey % 4 <> 0 AS source FROM part)
SELECT a.artifact, CASE WHEN s.bounds IS NULL THEN 'unknown' WHEN a.bounds <> s.bounds THEN 'elsewhere' ELSE 'ok' END AS state FROM a LEFT JOIN a s ON s.source AND s.source_id = a.source_id WHERE NOT a.source""")
def source_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    a = views.table(spark, sf_dir, "part").select(
        k.alias("artifact"), F.floor(k / 3).alias("source_id"), F.array(F.lit(0), F.lit(10) + F.when(k % 8 == 5, 1).otherwise(0)).alias("bounds"), F.when((k % 3 == 0) & (k % 4 != 0), "source").otherwise("labels").alias("kind")
    )
    return workflow.sources_agree(a)


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 3 THEN 'new' WHEN p_partkey % 5 = 0 THEN 'differs' ELSE 'same' END AS state FROM part""")
def info_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey"), views.table(spark, sf_dir, "part")
    row = lambda dtype: (k.alias("id"), F.lit("image").alias("kind"), dtype.alias("dtype"), F.lit(1).alias("channels"), F.lit(None).cast("string").alias("scale"))
    return workflow.grid_compatible(p.select(*row(F.lit("uint8"))), p.filter(k % 4 != 3).select(*row(F.when(k % 5 == 0, "uint16").otherwise("uint8"))))


@query("""SELECT user_id, event_id, (SELECT arg_max(p.value, (p.ts, p.value)) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) AS price FROM events e""")
def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.table(spark, sf_dir, "events")
    bought = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"))
    return workflow.as_of(e.select("user_id", "ts", "event_id"), bought, "user_id", "ts", "price").select("user_id", "event_id", "price")


@query("""WITH t AS (SELECT page_id, page_id // 10 AS tour, (page_id % 10) * 2.5::DOUBLE AS t, url FROM pages), n AS (SELECT *, row_number() OVER w - 1 AS place, coalesce(lead(t) OVER w - t, 0.0) AS s FROM t WINDOW w AS (PARTITION BY tour ORDER BY t))
SELECT tour, CAST(place * 2 AS INT) AS line, url AS text FROM n UNION ALL SELECT tour, CAST(place * 2 + 1 AS INT), s::VARCHAR FROM n""")
def video_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    return camera.video_lines(views.table(spark, sf_dir, "pages").select(F.floor(k / 10).alias("tour"), (k % 10 * 2.5).alias("t"), "url"), "tour")


@query("""WITH l AS (SELECT p_partkey // 4 AS tour, p_partkey % 4 AS position, p_name AS name, p_size AS s FROM part)
SELECT tour, '{"position":[' || (avg(s)::DOUBLE) || ',' || (avg(s * 2)::DOUBLE) || ',0.5],"crossSectionScale":8.0,"layers":[' || string_agg('{"type":"image","source":"a://' || position || '","name":"' || name || '"}', ',' ORDER BY position) || '],"layout":"xy"}' AS state FROM l GROUP BY 1""")
def viewer_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    at = F.concat(F.lit("a://"), (k % 4).cast("string"))
    rows = views.table(spark, sf_dir, "part").select(F.floor(k / 4).alias("tour"), (k % 4).alias("position"), F.col("p_name").alias("name"), F.lit("image").alias("kind"), at.alias("source"), n.alias("x"), (n * 2).alias("y"), F.lit(0.5).alias("z"))
    return documents.viewer_states(rows, "tour", 8.0)


@query("""WITH m AS (SELECT p_brand AS project, p_partkey AS name, p_retailprice AS score, p_brand NOT LIKE '%1' AS has_truth FROM part)
SELECT project, name, CASE WHEN has_truth THEN CAST(row_number() OVER (PARTITION BY project ORDER BY score DESC, name) AS INT) END AS rank, 'withheld' AS approval FROM m""")
def evidence_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part").select(F.col("p_brand").alias("project"), F.col("p_partkey").alias("name"), F.col("p_retailprice").alias("score"), (~F.col("p_brand").endswith("1")).alias("has_truth"))
    return workflow.evidence(p).select("project", "name", "rank", "approval")


@query("SELECT p_partkey AS project, 0.25::DOUBLE AS beta FROM part")
def chosen_sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("project"), F.explode(F.array(*map(F.lit, (0.1, 0.25, 0.5)))).alias("beta"))
    return workflow.chosen(p, spark.createDataFrame([(0.25 + 1e-13,)], "beta double"))


@query("SELECT count(*) AS pages, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes FROM pages")
def delivery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "pages").agg(F.count("*").alias("pages"), F.sum(F.octet_length("html").cast("long")).alias("bytes"))


# Plain SQL features and streams ------------------------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, GROUPING(l_returnflag) AS g1, GROUPING(l_linestatus) AS g2, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus")
    return t.agg(F.grouping("l_returnflag").alias("g1"), F.grouping("l_linestatus").alias("g2"), F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("""SELECT event_id, CAST(rank() OVER w AS INT) AS rank, CAST(dense_rank() OVER w AS INT) AS dense, CAST(ntile(4) OVER v AS INT) AS quarter, lag(event_id) OVER v AS before, lead(event_id) OVER v AS after, round(cume_dist() OVER w, 9) AS share
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_type), v AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def analytic_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    w, v = W.partitionBy("user_id").orderBy("event_type"), W.partitionBy("user_id").orderBy("ts", "event_id")
    e = views.table(spark, sf_dir, "events")
    return e.select("event_id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense"), F.ntile(4).over(v).alias("quarter"), F.lag("event_id").over(v).alias("before"), F.lead("event_id").over(v).alias("after"), F.round(F.cume_dist().over(w), 9).alias("share"))


@query("""WITH s AS (SELECT h + INTERVAL (k) HOUR AS start, event_type, value FROM (SELECT date_trunc('hour', ts) AS h, event_type, value FROM events) t, (VALUES (0), (-1)) v(k))
SELECT start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM s GROUP BY 1, 2""")
def event_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stages.windowed(views.table(spark, sf_dir, "events"), "2 hours", "1 hour")
    return out.select("start", "event_type", "n", F.round("total", 6).alias("total"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def event_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.once(views.table(spark, sf_dir, "events"), ["user_id", "event_type"]).select("user_id", "event_type")
