"""Keyed enrichment: a left join against a landed registry, then the sheet layout.

The per-key remote fetch of the original workflow becomes one left join: keys on
the preserved side, one record per key on the other. Catalyst/AQE choose between
sort-merge and broadcast from measured sizes; the registry is never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwise.functions.text import clean_text, pad_key

FOUND = "found"


def lookup_join(keys: DataFrame, registry: DataFrame, key: str,
                found_col: str = FOUND, record_col: str | None = None,
                pad_width: int | None = None, one_per_key: bool = False,
                stored_padded: bool = False) -> DataFrame:
    """Left join ``keys`` to ``registry`` on ``key``; flag whether a record matched.

    Every key row is kept (key-only row when absent); duplicate keys stay
    duplicated. One plan for every size: Spark picks the join from the measured
    sizes and splits skewed partitions.

    ``record_col`` carries the registry's columns as one struct of that name, so
    they never clash with those of ``keys``; without it they are added as columns,
    and a name held by both sides is an error. ``pad_width`` pads the key with
    zeros on both sides before comparing (the output has the padded key);
    ``stored_padded`` says that the registry holds it padded already, so that one laid
    out in buckets of its key (``writers.save_bucketed``) is joined without a shuffle. A
    registry key held more than once multiplies its key rows, unless
    ``one_per_key`` keeps one record (the smallest) of each; see ``duplicate_keys``.
    """
    fields = [c for c in registry.columns if c != key]
    names = {record_col} if record_col else set(fields)
    clash = names & set(keys.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; name a record_col")
    left, right = keys, registry
    if pad_width:
        left = keys.withColumn(key, pad_key(key, pad_width))
        right = registry if stored_padded else registry.withColumn(key, pad_key(key, pad_width))
    record = F.struct(*[F.col(f"`{c}`") for c in fields]) if fields else F.lit(True)
    hit = right.select(F.col(f"`{key}`"), record.alias("_tw_hit")).where(F.col(f"`{key}`").isNotNull())
    if one_per_key:
        hit = hit.groupBy(key).agg(F.min("_tw_hit").alias("_tw_hit"))
    out = left.join(hit, on=key, how="left").withColumn(found_col, F.col("_tw_hit").isNotNull())
    kept = [F.col(f"`{c}`") for c in keys.columns]
    added = ([F.col("_tw_hit").alias(record_col)] if record_col
             else [F.col("_tw_hit")[c].alias(c) for c in fields])
    return out.select(*kept, *added, found_col)


def duplicate_keys(registry: DataFrame, key: str) -> DataFrame:
    """Keys held more than once (empty when the registry is a proper lookup)."""
    return registry.groupBy(key).count().where(F.col("count") > 1)


def found_or_key_only(keys: DataFrame, registry: DataFrame, key: str, pad_width: int | None = None,
                      one_per_key: bool = False) -> DataFrame:
    """Found records plus key-only rows for the misses, stacked by name.

    The rows of ``lookup_join`` without the flag: one left join gives what the
    original row-by-row append of both kinds produced. Names held by both sides are an
    error, as there; ``pad_width`` and ``one_per_key`` mean the same.
    """
    flag = "_tw_found"
    return lookup_join(keys, registry, key, found_col=flag, pad_width=pad_width, one_per_key=one_per_key).drop(flag)


def bind_columns(tables: dict[str, DataFrame], label: str, repeated: str = "fail") -> DataFrame:
    """Tables side by side, aligned by ``label``: one row per label that any of them has.

    A label that a table lacks has nulls in that table's columns; null is a label like
    others. A name that several tables have becomes ``<table>_<name>``. A label that a
    table holds more than once is an error, or its smallest row counts
    (``repeated="smallest"``, for orderable columns). All tables are stacked and
    grouped once, so each is shuffled once however many there are, and repeated
    labels are combined before the shuffle.
    """
    if repeated not in ("fail", "smallest"):
        raise ValueError(f"repeated must be 'fail' or 'smallest', not {repeated!r}")
    names = [c for df in tables.values() for c in df.columns if c != label]
    stacked, columns = None, []
    for i, (table, df) in enumerate(tables.items()):
        cells = [F.col(f"`{c}`") for c in df.columns if c != label]
        # A table of labels alone still says which labels it has.
        part = df.select(F.col(f"`{label}`").alias("_tw_label"), F.struct(F.lit(i).alias("_tw_table"), *cells).alias(f"_tw_{i}"))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
        columns += [F.col(f"_tw_{i}")[c].alias(c if names.count(c) == 1 else f"{table}_{c}") for c in df.columns if c != label]
    one = F.min if repeated == "smallest" else lambda c: F.any_value(c, F.lit(True))
    grouped = stacked.groupBy("_tw_label").agg(
        *[one(f"_tw_{i}").alias(f"_tw_{i}") for i in range(len(tables))],
        *[F.count(f"_tw_{i}").alias(f"_tw_n{i}") for i in range(len(tables))])
    if repeated == "fail":
        for i, table in enumerate(tables):
            said = F.concat(F.lit(f"{table} repeats the label "), F.coalesce(F.col("_tw_label").cast("string"), F.lit("null")))
            grouped = grouped.where(F.when(F.col(f"_tw_n{i}") <= 1, True).otherwise(F.raise_error(said).cast("boolean")))
    return grouped.select(F.col("_tw_label").alias(label), *columns)


def record_layout(df: DataFrame, spec: list[tuple]) -> DataFrame:
    """Reshape a record into a fixed column layout in one ``select``.

    ``spec`` rows are ``(output_name, source, dtype, clean)``: ``source`` is a
    column name or dotted struct path (or a Column), ``dtype`` an optional cast,
    ``clean`` whether to apply ``clean_text``. One source may feed several outputs.
    """
    cols = []
    for out_name, source, dtype, clean in spec:
        c = F.col(source) if isinstance(source, str) else source
        if clean:
            c = clean_text(c)
        if dtype:
            c = c.cast(dtype)
        cols.append(c.alias(out_name))
    return df.select(*cols)
