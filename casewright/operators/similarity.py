"""Filter to records that have a near-equal partner under the same key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casewright.operators.joins import KeyFilter
from casewright.session import Workspace

#: Rows compared with each other in one array.
CHUNK_ROWS = 64


def _texts(columns: list[str]) -> list[Column]:
    """The compared values of a row as texts."""
    return [F.col(f"_row.{c}").cast("string") for c in columns]


#: A bucket's name: two 64-bit hashes of the key, the parts chosen and the values there.
BUCKET = ["_b1", "_b2"]


def _names(*parts: Column) -> list[Column]:
    """Names of a bucket from parts without nulls inside, which hashes would pass over."""
    return [F.xxhash64(F.lit(i), *parts).alias(b) for i, b in enumerate(BUCKET)]


def _marked(texts: list[Column]) -> Column:
    """Texts told apart from a missing one."""
    return F.array(*[F.coalesce(F.concat(F.lit("="), t), F.lit("")) for t in texts])


def _dealt(rows: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Each row once per part of its remaining columns, in the bucket of the values it has there."""
    left, part, cells = F.col("_left"), F.col("_part"), F.col("_cells")
    return (
        rows.withColumn("_cells", _marked(_texts(columns)))
        .withColumn("_part", F.explode(F.array(*[F.lit(j) for j in range(parts)])))
        .withColumn("_values", F.transform(F.filter(left, lambda _, i: i % parts == part), lambda c: F.element_at(cells, c + 1)))
        .select("_row", "_seeks", F.filter(left, lambda _, i: i % parts != part).alias("_left"), *_names(*[F.col(b) for b in BUCKET], part, F.col("_values")))
    )


def _partners(rows: DataFrame, columns: list[str], need: int) -> DataFrame:
    """Rows that find a partner among the rows of their bucket and chunk, where all are compared."""

    # What is text already is compared where it stands, so that it travels once.
    plain = {f.name for f in rows.schema["_row"].dataType.fields if f.dataType == StringType()}
    names = {c: f"c{i}" for i, c in enumerate(columns) if c not in plain}

    def agree(a: Column, b: Column) -> Column:
        pairs = [(a[names[c]], b[names[c]]) if c in names else (a["_row"][c], b["_row"][c]) for c in columns]
        return reduce(lambda x, y: x + y, [x.eqNullSafe(y).cast("int") for x, y in pairs]) >= need

    member = F.struct("_row", "_seeks", *[t.alias(names[c]) for t, c in zip(_texts(columns), columns) if c in names])
    groups = rows.groupBy(*BUCKET, "_chunk").agg(F.collect_list(member).alias("_group")).filter(F.size("_group") > 1)
    # Members carry their place, so that none is its own partner.
    placed = groups.select(F.transform("_group", lambda x, i: F.struct(i.alias("i"), x.alias("m"))).alias("_group"))
    found = F.filter("_group", lambda x: x["m"]["_seeks"] & F.exists("_group", lambda o: (o["i"] != x["i"]) & agree(o["m"], x["m"])))
    return placed.select(F.explode(found).alias("_found")).select("_found.m._row")


def _search(work: Workspace, rows: DataFrame, columns: list[str], need: int, chunk_rows: int) -> list[DataFrame]:
    """Rows with a partner that agrees on ``need`` columns, found bucket by bucket.

    Rows that agree on ``need`` of ``n`` columns differ in ``n - need`` at most, so
    of ``n - need + 1`` parts of the columns they agree on one as a whole: each
    row goes to one bucket per part and meets all its partners in some of them.
    Inside a bucket rows are compared in chunks. That settles all buckets of one
    chunk; of larger ones it settles the rows that found somebody. Those that
    did not go on: the columns left are dealt to as many parts again, and the
    bucket's rows meet them in the smaller buckets so formed, until the buckets
    are small or agree on enough columns already.
    """
    parts = len(columns) - need + 1
    found = []
    while True:
        dealt = work.stage(_dealt(rows, columns, parts), "buckets")
        sizes = dealt.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("_size"), F.bool_or("_seeks").alias("_sought")).filter("_size > 1 AND _sought")
        sizes = work.stage(sizes, "sizes")
        chunk = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_size") / F.lit(chunk_rows)).cast("long"))
        # Most rows are alone in a bucket: these are not moved.
        shared = KeyFilter(sizes, BUCKET[0], work)(dealt)
        met = work.stage(shared.join(sizes, BUCKET).withColumn("_chunk", chunk), "met")
        # As many columns are left as were needed less what the bucket shares, plus the parts but one.
        enough = F.size("_left") < parts
        settled = met.filter(enough & F.col("_seeks")).select("_row").unionByName(_partners(met.filter(~enough), columns, need))
        large = met.filter(~enough & (F.col("_size") > chunk_rows))
        if large.isEmpty():
            return [*found, settled]
        found.append(work.stage(settled.distinct(), "found"))
        have = reduce(DataFrame.unionByName, found).withColumnRenamed("_row", "_have")
        large = large.join(have.distinct(), F.col("_row") == F.col("_have"), "left").withColumn("_seeks", F.col("_seeks") & F.col("_have").isNull())
        large = work.stage(large.select("_row", "_seeks", "_left", *BUCKET), "large")
        open_buckets = large.filter("_seeks").select(*BUCKET).distinct()
        rows = work.stage(large.join(open_buckets, BUCKET, "left_semi"), "rows")
        if rows.isEmpty():
            return found


def similarity_filter(df: DataFrame, keys: list[str], threshold: float = 0.9, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows whose best partner under the same key agrees on at least ``threshold`` of the other columns.

    Two nulls agree, one null does not; a row alone under its key is kept. Equal
    rows are counted first, so copies never travel.
    """
    others = [c for c in df.columns if c not in keys]
    n = len(others)
    if not keys or threshold <= 0:
        return df
    if threshold > 1:
        return df.filter(F.lit(False))
    work = Workspace(df.sparkSession, "similarity")
    # Structs compare field by field with null equal to null, as the rule asks.
    keyed = df.withColumn("_row", F.struct(*df.columns))
    copies = work.stage(
        keyed.groupBy("_row").agg(F.count(F.lit(1)).alias("_n")).select("_row", "_n", F.struct(*[F.col(f"_row.{k}") for k in keys]).alias("_key")), "copies")
    sized = work.stage(copies.join(copies.groupBy("_key").agg(F.sum("_n").alias("_rows")), "_key"), "sized")
    kept = [sized.filter("_rows = 1").select("_row")]
    # The share is compared as the quotient itself, so 9/10 meets 0.9 exactly.
    need = next((m for m in range(1, n + 1) if m / n >= threshold), None)
    if need is not None:
        kept.append(copies.filter("_n > 1").select("_row"))
        key = _marked([F.col(f"_key.{k}").cast("string") for k in keys])
        rows = sized.filter("_rows > 1").select(
            "_row", (F.col("_n") == 1).alias("_seeks"), F.array(*[F.lit(c) for c in _by_variety(copies, others)]).alias("_left"), *_names(key))
        kept += _search(work, rows, others, need, chunk_rows)
    return keyed.select("_row").join(reduce(DataFrame.unionByName, kept).distinct(), "_row", "left_semi").select("_row.*")


def _by_variety(copies: DataFrame, columns: list[str]) -> list[int]:
    """Columns with many values first, so that each part gets some of them."""
    counts = copies.agg(*[F.approx_count_distinct(F.col(f"_row.{c}").cast("string")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return sorted(range(len(columns)), key=lambda i: (-counts[f"c{i}"], i))
