"""Checks of a dataset against its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.geometry import geom_bbox, geom_equals_within, geom_key, is_collection
from strandline.operators.aggregates import single_value_check
from strandline.operators.gate import skip_quarantined
from strandline.operators.geojoin import KEY, distinct_keys
from strandline.operators.naming import quoted
from strandline.operators.packing import ROWS_PER_CHUNK, row_chunk
from strandline.operators.sampling import sample_files, sample_rows_per_file
from strandline.operators.skew import skew_join
from strandline.operators.spatial import contained, containment_join, endless, near_containers
from strandline.session import write_through

# Verdicts on one probe, from worst to best.
STATUSES = ("not_contained", "unsupported", "contained_not_exact", "near_copy", "no_control_column", "control_mismatch",
            "match")
# Sizes of the sampled check, and the distance within which a vertex is the same but for rounding.
SAMPLE_FILES, SAMPLE_ROWS, NEAR = 3, 5, 0.001


_RANKS = {status: rank for rank, status in enumerate(STATUSES)}


def _control(column: str) -> Column:
    """A control value as text that is never null, so that null equals null."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(column)).cast("string")), F.lit("null"))


def lookup_status(probes: DataFrame, dataset: DataFrame, probe_id: list[str], control: str | None,
                  geometry: str = "geometry", few_probes: bool = False, near: float = NEAR,
                  box: str | None = None) -> DataFrame:
    """One row per ``probe_id``, which must be unique, with ``status``, the best verdict over the whole dataset.

    A probe must be contained in a dataset geometry, equal one exactly, and agree
    with that one's control value. One whose vertices lie within ``near`` of a containing geometry's
    is a ``near_copy``, such as a value that went through rounded text. ``unsupported`` are collections in reach of
    something, probes in reach of nothing but collections, and coordinates without end.

    Verdicts are reached in stages, each for what the one before has left, and for distinct geometries on both sides. Equal
    geometries contain each other, so they meet by their bytes alone; near copies by the grid of their first vertices, and
    only such a pair is tested; the rest in a join that looks for one container of a probe and stops there.

    ``few_probes`` promises a sample of bounded size; the dataset is then not shuffled. ``box`` names a stored bounding box
    of the dataset, which spares decoding what cannot contain a probe.
    """
    known = control is not None and control in dataset.columns
    told = control is not None and control in probes.columns
    kept = [*([_control(control).alias("theirs")] if known else []), F.col(geometry).alias("geometry"),
            *([F.col(box).alias("box")] if box else [])]
    held = dataset.where(F.col(geometry).isNotNull()).select(*kept)
    sought = probes.select(F.struct(*map(quoted, probe_id)).alias("probe"), (_control(control) if told else F.lit(None)).alias("ours"),
                           F.col(geometry).alias("geometry")).withColumn(KEY, geom_key(F.col("geometry")))
    if few_probes:
        ranked = _few_ranked(held, sought, known, near, box)
    else:
        ranked = _ranked(held.distinct(), sought, known, near, box)
    # Every probe starts at the worst verdict; one aggregation by probe finds its best, found or not.
    status = F.array(*[F.lit(s) for s in STATUSES])
    return (ranked.groupBy("probe").agg(F.max("rank").alias("rank"))
            .select(*(F.col(f"probe.{quoted(c)}").alias(c) for c in probe_id), F.get(status, F.col("rank")).alias("status")))


def _verdict(known: bool) -> Column:
    """The rank of a probe that equals a dataset geometry."""
    if not known:
        return F.lit(_RANKS["no_control_column"])
    return F.when(F.col("theirs") == F.col("ours"), _RANKS["match"]).otherwise(_RANKS["control_mismatch"])


def _few_ranked(held: DataFrame, sought: DataFrame, known: bool, near: float, box: str | None) -> DataFrame:
    """``probe, rank`` for a sample of probes, pair by pair."""
    pairs = containment_join(held, sought, ["theirs"] if known else [], ["probe", "ours"], "geometry",
                             container_box="box" if box else None, few_probes=True, keep_geometry=True)
    rank = (F.when(F.col("relation") == "unsupported", _RANKS["unsupported"])
            .when(F.col("container_geometry") == F.col("probe_geometry"), _verdict(known))
            .when(geom_equals_within("container_geometry", "probe_geometry", near), _RANKS["near_copy"])
            .otherwise(_RANKS["contained_not_exact"]))
    return pairs.where("probe is not null").select("probe", rank.alias("rank")).unionByName(
        sought.select("probe", F.lit(0).alias("rank")))


def _ranked(held: DataFrame, sought: DataFrame, known: bool, near: float, box: str | None) -> DataFrame:
    """``probe, rank`` in stages; a probe may have more than one rank."""
    held = held if box else held.withColumn("box", geom_bbox("geometry"))
    held = write_through(held.withColumn(KEY, geom_key(F.col("geometry"))), "dataset")  # boxes are found once
    able = ~is_collection(F.col("geometry")) & F.col("geometry").isNotNull()
    placed = able & held["box"].isNotNull() & ~endless(held["box"])

    equal = held.where(placed).select(KEY, *(["theirs"] if known else [])).distinct()
    if known:
        agreed = equal.withColumn("agrees", F.lit(True))
        equal = equal.select(KEY).distinct()
        sought = skew_join(sought, agreed.withColumnRenamed("theirs", "ours"), [KEY, "ours"], "left")
    sought = skew_join(sought, equal.withColumn("equal", F.lit(True)), [KEY], "left")
    exact = F.lit(_RANKS["no_control_column"])
    if known:
        exact = F.when(F.col("agrees"), _RANKS["match"]).otherwise(_RANKS["control_mismatch"])
    sought = write_through(sought.select("probe", "geometry", KEY, F.when(F.col("equal"), exact).alias("rank")), "probes")

    shapes = held.select(KEY, "geometry", "box").dropDuplicates([KEY])
    left = write_through(sought.where(F.col("rank").isNull() & F.col(KEY).isNotNull()).select(KEY, "geometry").dropDuplicates([KEY]), "left")
    copies = write_through(near_containers(left.where(able), shapes.where(placed), KEY, near), "copies")
    rest = skew_join(left, copies, [KEY], "left_anti")
    held_by = contained(rest, shapes, [KEY], container_box="box")
    rank = F.when(F.col("relation") == "contains", _RANKS["contained_not_exact"]).otherwise(_RANKS["unsupported"])
    others = held_by.select(KEY, rank.alias("other")).unionByName(copies.select(KEY, F.lit(_RANKS["near_copy"]).alias("other")))
    best = skew_join(sought, others, [KEY], "left")
    return best.select("probe", F.coalesce("rank", "other", F.lit(0)).alias("rank"))


def sampled_probes(source: DataFrame, failed: DataFrame, control: str, file: str = "_source_file", fid: str = "_fid",
                   n_files: int = SAMPLE_FILES, n_rows: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """The probes of the sampled check: rows of sampled files that did not fail, with their file's control value.

    Adds ``single_control`` (the file has one control value only) and puts the file's first value in ``control``.
    """
    files = skip_quarantined(
        sample_files(source.select(file).distinct(), file, n_files, seed), failed, file)
    # At most n_files names reach the driver; as constants they prune partitions and row groups.
    rows = source.where(F.col(file).isin([r[0] for r in files.collect()]))
    checks = single_value_check(rows, file, control, fid).select(
        file, F.col("first_value").alias("_control"), F.col("is_single").alias("single_control"))
    picked = sample_rows_per_file(rows, file, fid, n_rows, seed)
    return (picked.join(checks, file)
            .withColumn(control, F.col("_control")).drop("_control"))


def reconcile_sampled(source: DataFrame, dataset: DataFrame, failed: DataFrame, control: str,
                      file: str = "_source_file", fid: str = "_fid", geometry: str = "geometry",
                      n_files: int = SAMPLE_FILES, n_rows: int = SAMPLE_ROWS, seed: int = 0,
                      box: str | None = None) -> DataFrame:
    """Sampled rows of sampled files looked up in the dataset: file, fid, control, single_control, status."""
    probes = write_through(
        sampled_probes(source, failed, control, file, fid, n_files, n_rows, seed)
        .select(file, fid, control, "single_control", geometry), "probes")
    status = lookup_status(probes, dataset, [file, fid], control, geometry, few_probes=True, box=box)
    return probes.select(file, fid, control, "single_control").join(status, [file, fid])


def reconcile_chunks(source: DataFrame, dataset: DataFrame, order_by: list[str], fid: str = "_fid",
                     geometry: str = "geometry", chunk_rows: int = ROWS_PER_CHUNK,
                     head_rows: int | None = None) -> DataFrame:
    """Per chunk of source features: matched, unmatched and distinct geometries against the dataset.

    The dataset side is all of it, or its first ``head_rows`` rows in ``order_by`` order. Source copies within a chunk shrink to one row before the join.
    """
    head = dataset if head_rows is None else dataset.orderBy(*order_by).limit(head_rows)
    keys = write_through(distinct_keys(head, geometry), "keys").withColumn("_found", F.lit(True))  # read twice
    n_keys = keys.agg(F.count("*")).scalar()
    chunked = (source.withColumn("chunk_id", row_chunk(F.col(fid), chunk_rows))
               .withColumn(KEY, geom_key(F.col(geometry)))
               .groupBy("chunk_id", KEY).agg(F.count("*").alias("_n")))
    joined = chunked.join(keys, KEY, "left")
    found, keyed = F.col("_found").isNotNull(), F.col(KEY).isNotNull()
    zero = F.lit(0).cast("bigint")
    return joined.groupBy("chunk_id").agg(
        F.sum("_n").alias("n_features"),
        F.coalesce(F.sum(F.when(found, F.col("_n"))), zero).alias("matched"),
        F.coalesce(F.sum(F.when(~found & keyed, F.col("_n"))), zero).alias("unmatched_source"),
        (n_keys - F.count_if(found)).alias("unmatched_dataset"),
        F.count_if(keyed).alias("unique_source"))
