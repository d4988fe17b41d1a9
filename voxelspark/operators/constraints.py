"""Settings as rows, and rules over them that fail closed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelspark.functions import scalars as S


def violations(rows: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """(key, rule) for each rule that does not hold (null does not).  One pass over the rows."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*failed))).alias("rule"))


def enforce(rows: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """The rows, or an error that names what fails."""
    bad = violations(rows, rules, key).limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r[0]}: {r[1]}" for r in bad))
    return rows


#: Names of revisions that move, the fields of a profile, kernels, encodings, axes.
MUTABLE = ("main", "master", "head", "latest", "develop", "dev")
KERNELS = (1, 3, 5, 7, 9, 11)
ENCODINGS = ("raw", "jpeg", "compressed_segmentation")
SOURCE_AXES = ("yx", "xy", "zyx", "xyz", "zyxc", "xyzc")
SAFE_NAME = "^[A-Za-z0-9][A-Za-z0-9._-]*$"
HEX64 = "^[0-9a-fA-F]{64}$"


def _text(name: str) -> Column:
    return F.length(F.trim(name)) > 0


def _all(left: str, right: str, ok) -> Column:
    """Whether ``ok`` holds for the entries of two arrays, which are of one length."""
    return (F.size(left) == F.size(right)) & F.forall(F.zip_with(left, right, ok), lambda b: F.coalesce(b, F.lit(False)))


def _box_in(box: Column, shape: Column) -> Column:
    """A flat box z0, y0, x0, z1, y1, x1 within a shape, no side empty."""
    sides = F.zip_with(F.slice(box, 1, 3), F.slice(box, 4, 3), lambda a, b: (a >= 0) & (b > a))
    ends = F.zip_with(F.slice(box, 4, 3), shape, lambda b, n: b <= n)
    return (F.size(box) == 6) & F.forall(sides, lambda b: b) & F.forall(ends, lambda b: b)


def _distinct(a: str) -> Column:
    return F.size(F.array_distinct(a)) == F.size(a)


def tile_rules() -> dict[str, Column]:
    """Tiled inference: core within patch, halo under half a patch, vectors positive."""
    return {
        "core": S.is_vector(F.col("core")),
        "patch": S.is_vector(F.col("patch")),
        "core_in_patch": _all("core", "patch", lambda c, p: c <= p),
        "halo_under_half": _all("halo", "patch", lambda h, p: h * 2 < p),
        "beta": (F.col("beta") > 0) & (F.col("beta") < 1),
        "commit": F.col("commit").rlike("^[0-9a-f]{40}$"),
        "digest": F.col("digest").rlike("^[0-9a-f]{64}$"),
    }


def neuron_rules() -> dict[str, Column]:
    """A neuron segmentation project, one row: identity, source, model, planning, instances, output and
    commands.  ``env_keys`` and ``argv`` are arrays of all commands' entries."""
    target = F.col("target")
    return {
        "project_id": F.col("project_id").rlike(SAFE_NAME),
        "source_uri": _text("source_uri"),
        "source_format": _text("source_format"),
        "axis_order": F.array_join(F.array_sort(F.split(F.lower("axis_order"), "")), "") == "xyz",
        "shape": S.is_vector(F.col("shape")) & S.whole(F.col("shape")),
        "resolution": S.is_vector(F.col("resolution")),
        "offset": (F.size("offset") == 3) & S.whole(F.col("offset")),
        "bbox": _box_in(F.col("bbox"), F.col("shape")),
        "read_only": F.col("read_only"),
        "identity": _text("identity"),
        "repository": _text("repository"),
        "commit_pinned": ~F.lower("commit").isin(*MUTABLE) & F.col("commit").rlike("^[0-9a-fA-F]{7,40}$"),
        "checkpoint": _text("checkpoint"),
        "checkpoint_sha256": F.col("checkpoint_sha256").rlike(HEX64),
        "target": S.is_vector(target),
        "xy_range": (F.size("xy_range") == 2) & (F.get("xy_range", F.lit(0)) <= F.get("xy_range", F.lit(1))),
        "target_in_range": F.forall(F.slice(target, 2, 2), lambda v: v.between(F.get("xy_range", F.lit(0)), F.get("xy_range", F.lit(1)))),
        "z_policy": F.lower("z_policy").isin("preserve", "explicit"),
        "z_preserved": (F.lower("z_policy") != "preserve") | (F.abs(F.get(target, F.lit(0)) - F.get("resolution", F.lit(0))) <= 1e-9),
        "normalization": _text("normalization"),
        "patch": S.is_vector(F.col("patch")),
        "halo": (F.size("halo") == 3) & F.forall("halo", lambda h: h >= 0),
        "halo_under_half": _all("halo", "patch", lambda h, p: h * 2 < p),
        "core_in_patch": S.is_vector(F.col("core")) & _all("core", "patch", lambda c, p: c <= p),
        "max_end_error": F.col("max_end_error") >= 0,
        "pilot_rois": (F.size("pilot_rois") > 0) & F.forall("pilot_rois", lambda r: _box_in(r, F.col("shape"))),
        "scope": F.col("scope").isin("whole-volume", "per-block"),
        "label_dtype": F.col("label_dtype").isin("uint32", "uint64"),
        "background": F.col("background") == 0,
        "reconciliation": (F.col("scope") != "per-block") | F.coalesce("reconciliation", F.lit(False)),
        "betas": F.col("betas").isNull() | ((F.size("betas") >= 2) & F.forall("betas", lambda b: (b > 0) & (b < 1))),
        "betas_unique": F.col("betas").isNull() | _distinct("betas"),
        "output_apart": ~S.overlaps_source(F.col("output"), F.col("source_uri")),
        "argv": F.forall("argv", lambda a: F.length(a) > 0),
        "secrets": ~F.exists("env_keys", S.secret_key),
        "sweep_placeholders": F.col("betas").isNull() | (F.exists("argv", lambda a: a.contains("{beta}")) & F.exists("argv", lambda a: a.contains("{selected_beta}"))),
    }


def profile_rules() -> dict[str, Column]:
    """Profiles of plane-wise inference."""
    f = F.col("downsample").cast("int")
    ratio = F.array_max("voxel") / F.array_min("voxel")
    return {
        "downsample_power_of_two": (f > 0) & (f.bitwiseAND(f - 1) == 0),
        "median_kernel_odd": F.col("median_kernel").isin(*KERNELS),
        "threshold": F.col("threshold").between(0.0, 1.0),
        "anisotropy": (ratio <= 2) | ~F.col("orthoplane"),
    }


def mito_rules() -> dict[str, Column]:
    """A profile of organelle inference with its project's source and model, one row."""
    f = F.col("downsample_factor").cast("int")
    shares = ("segmentation_confidence", "center_confidence", "merge_iou", "merge_ioa", "cluster_iou")
    counts = ("center_min_distance", "min_size_vox", "min_span_slices", "label_divisor")
    ratio = F.array_max("target") / F.array_min("target")
    return {
        "project_id": F.col("project_id").rlike(SAFE_NAME),
        "axis_order": F.array_join(F.array_sort(F.split(F.lower("axis_order"), "")), "") == "xyz",
        "shape": S.is_vector(F.col("shape")),
        "resolution": S.is_vector(F.col("resolution")),
        "bbox": _box_in(F.col("bbox"), F.col("shape")),
        "read_only": F.col("read_only"),
        "commit": F.col("commit").rlike("^[0-9a-fA-F]{40}$"),
        "variant": F.col("variant").isin("MitoNet_v1", "MitoNet_v1_mini"),
        "target": S.is_vector(F.col("target")),
        "z_policy": F.col("z_policy").isin("preserve", "explicit"),
        "z_preserved": (F.col("z_policy") != "preserve") | (F.abs(F.get("target", F.lit(0)) - F.get("resolution", F.lit(0))) <= 1e-9),
        "checkpoint_sha256": F.col("checkpoint_sha256").rlike(HEX64),
        "model_config_sha256": F.col("model_config_sha256").rlike(HEX64),
        "profile": F.col("profile").rlike(SAFE_NAME),
        "mode": F.col("mode").isin("stack", "orthoplane"),
        "anisotropy": (F.col("mode") != "orthoplane") | (ratio <= 2) | F.coalesce("orthoplane_reviewed", F.lit(False)),
        "median_kernel": F.col("median_kernel").isin(*KERNELS),
        **{c: F.col(c).between(0.0, 1.0) for c in shares},
        "pixel_vote": F.col("pixel_vote").isin(1, 2, 3),
        **{c: (F.col(c) > 0) & (F.col(c) == F.floor(c)) for c in counts},
        "downsample_factor": (f > 0) & (f.bitwiseAND(f - 1) == 0),
        "output_apart": ~S.overlaps_source(F.col("output"), F.col("source_uri")),
        "secrets": ~F.exists("env_keys", S.secret_key),
    }


def advisor_rules() -> dict[str, Column]:
    """Region selection, one row a project.  ``windows`` are text such as 1x2x2; guards are flat boxes."""
    return {
        "axes": F.col("axes") == "zyx",
        "uri": _text("uri"),
        "shape": S.is_vector(F.col("shape")),
        "voxel": S.is_vector(F.col("voxel")),
        "patch": S.is_vector(F.col("patch")),
        "stride": S.is_vector(F.col("stride")),
        "boundary": F.col("boundary").isin("valid", "align_end", "reflect"),
        "patch_in_shape": (F.col("boundary") != "valid") | _all("patch", "shape", lambda p, n: p <= n),
        "dimension": F.col("dimension") > 0,
        "repository": _text("repository"),
        "commit": _text("commit"),
        "checkpoint_sha256": F.col("checkpoint_sha256").rlike(HEX64),
        "windows": F.size("windows") > 0,
        "window_shapes": F.forall("windows", lambda w: w.rlike("^[1-9][0-9]*x[1-9][0-9]*x[1-9][0-9]*$")),
        "windows_unique": _distinct("windows"),
        "max_items": F.col("max_items") > 0,
        "budget": F.col("budget") > 0,
        "k": F.col("k") > 0,
        "metric": F.col("metric").isin("euclidean", "cosine"),
        "alpha": F.col("alpha").between(0.0, 1.0),
        "guards": F.forall("guards", lambda g: _box_in(g, F.col("shape"))),
    }


def source_rules() -> dict[str, Column]:
    """Published datasets."""
    return {
        "url": S.plain_url(F.col("url")),
        "resolution": S.is_vector(F.col("resolution")),
        "offset": S.whole(F.col("offset")),
        "env": ~S.secret_key(F.col("env_key")),
    }


def precomputed_rules() -> dict[str, Column]:
    """Datasets to be written, one row each; that ids and outputs are unique is a matter of the table
    (``workflow.duplicates``)."""
    return {
        "id": _text("id"),
        "output": S.inside_folder(F.col("output")),
        "source": F.col("source").isNull() | _text("source"),
        "axes": F.col("source").isNull() | F.lower("axes").isin(*SOURCE_AXES),
        "output_apart": F.coalesce(F.col("source"), F.lit("")).isin("", " ") | ~S.overlaps_source(F.col("target"), F.col("source")),
        "layer_type": F.col("layer_type").isin("image", "segmentation"),
        "resolution": S.is_vector(F.col("resolution")),
        "offset": (F.size("offset") == 3) & F.forall("offset", lambda v: v.isNotNull()),
        "chunk": S.is_vector(F.col("chunk")),
        "encoding": F.col("encoding").isin(*ENCODINGS),
        "categorical": (F.col("layer_type") != "segmentation") | (F.col("encoding") != "jpeg"),
    }


def video_rules() -> dict[str, Column]:
    """A tour: seconds, frame, camera, layers' colours, region and stops, one row a layer."""
    seconds = ("metadata_seconds", "isolated_seconds", "density_seconds", "all_seconds", "zoom_seconds", "hold_seconds", "move_seconds")
    roi = [F.get("roi", F.lit(i)) for i in range(4)]
    return {
        "roots": F.col("source_root") != F.col("output_root"),
        **{c: F.col(c) >= 0 for c in seconds},
        "frame": (F.col("fps") > 0) & (F.col("width") > 0) & (F.col("height") > 0),
        "easing": F.col("easing").isin("linear", "smoothstep", "smootherstep", "cosine"),
        "entry_fov": F.col("entry_fov") >= 1,
        "hold_pan": F.col("hold_pan").between(0.0, 0.2),
        "hold_zoom": F.col("hold_zoom").between(0.0, 0.35),
        "zoom_out": F.col("zoom_out").between(0.0, 1.0),
        "colour": (F.size("rgb") == 3) & F.forall("rgb", lambda v: v.between(0, 255)),
        "opacity": F.coalesce("opacity", F.lit(0.6)).between(0.0, 1.0),
        "roi": F.col("roi").isNull() | ((F.size("roi") == 4) & (roi[0] < roi[1]) & (roi[2] < roi[3])),
        "mode": F.col("mode").isin("representative", "seeded_random"),
        "count": F.col("count") > 0,
        "seed": (F.col("mode") != "seeded_random") | F.col("seed").isNotNull(),
    }


def review_rules() -> dict[str, Column]:
    """Candidates of a review, with the raw image's grid and shape beside them, one row a candidate."""
    return {
        "name": _text("name"),
        "kind": F.lower("kind").isin("semantic", "instance"),
        "grid": F.col("grid_id") == F.col("raw_grid_id"),
        "provenance": _text("provenance"),
        "one_value": (F.lower("kind") != "semantic") | (F.col("values") <= 1),
        "shape": F.col("shape") == F.col("raw_shape"),
        "threshold": (F.col("threshold") > 0) & (F.col("threshold") <= 1),
        "axis": F.lower("axis").isin("xy", "xz", "yz"),
    }


def review_table_issues(candidates: DataFrame) -> DataFrame:
    """(review, issue) that only shows across candidates: a name twice, or kinds mixed."""
    per = candidates.groupBy("review").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.count_distinct(F.lower("kind")).alias("kinds"))
    found = F.array_compact(F.array(F.when(F.col("names") < F.col("n"), "duplicate_name"), F.when(F.col("kinds") > 1, "mixed_kinds")))
    return per.select("review", F.explode(found).alias("issue"))
