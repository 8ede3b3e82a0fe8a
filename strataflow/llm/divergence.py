"""Source divergence audit: which sources of a language differ, and by which terms, with dominance skybands.

Every (lang, source) group and every lang gives each kept term (one that at least ``min_docs`` documents of the lang hold) the
smoothed share p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two shares differ by f = floor((p - q)^2 / (p + q)). Part ``pair``
ranks the other sources of the lang by the sum of f over all kept terms, part ``term`` the group's own terms that are more
frequent in it than in the lang, the first ``k`` only.

*Terms.* For p > q, f grows with the group's count and falls with the lang's. So a term that is dominated (higher or equal group
count, lower or equal lang count, earlier in UTF-8 order) by k others cannot be among the first k. Each partition retains
the terms that fewer than k others dominate, its k-skyband; skybands are merged, ``FAN_IN`` partitions at a time, and only the
last one is ranked exactly. A group may hold any share of all terms: no task gets more than FAN_IN bands of it.

*Pairs.* Kept terms are dealt into cells by their hash. A cell sums f over its terms for all pairs of a block of sources with
another in a dense matrix, a few thousand terms at a time. Terms that a cell does not hold for either block have the
count 0 on both sides and are added as a number times one value.

Arithmetic is in integers: p by long division in steps of 1000, so that counts up to 10^15 are exact.

Defined cases: null text, lang and source count as ''; repeated rows count as documents of their own; a group without terms
still occurs, has pairs (value 0 where V = 0), and no terms; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import slices, texts_of
from .components import stored
from .terms import LETTERS, terms_of

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
# Distinct terms that a task holds before it sends them on.
HELD_TERMS = 400_000
# Rows whose skyband is taken at once; bands merged at a time.
BAND_ROWS = 200_000
FAN_IN = 32
# Rows of a cell, sources of a block, terms of a matrix.
CELL_ROWS = 200_000
BLOCK_SOURCES = 256
MATRIX_TERMS = 4096

_COUNTED = "lang string, source string, term string, n long, docs long"
_BAND = "lang string, source string, term string, n long, lang_n long, part int"


def count_terms(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; each group also has a row without term."""
    rows = df.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for text, lang, source in zip(*[texts_of(part.column(c)) for c in range(3)], strict=True):
                    times, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    own: Counter = Counter()
                    for piece in terms_of(text, LETTERS):
                        own.update(piece)
                    times.update(own)
                    docs.update(own.keys())
                if sum(len(times) for times, _ in held.values()) > HELD_TERMS:
                    yield from sent(held)
                    held = {}
        yield from sent(held)

    def sent(held) -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            terms = [None, *(t.decode() for t in times)]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.string()), pa.array([0, *times.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in times)], pa.int64()),
            ], names=["lang", "source", "term", "n", "docs"])

    return rows.mapInArrow(count, _COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """p of a count ``n`` in a group of ``total`` occurrences of ``terms`` kept terms."""
    part = (n + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    whole = (total + 2 * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", part, whole)


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same for arrays; ``whole`` is N + 2 V, at least 1."""
    left, out = n + 2, np.zeros(np.broadcast(n, whole).shape, np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // whole
        left = left % whole
    return out + 1


def differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(group: np.ndarray, n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Which rows fewer than ``k`` others of their group dominate; ``term`` numbers the terms in UTF-8 order."""
    order = np.lexsort((term, lang_n, -n, group))
    g, count, whole, place = group[order], n[order], lang_n[order], term[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (count[1:] != count[:-1]) | (whole[1:] != whole[:-1])])
    starts = np.flatnonzero(new)
    # Of equal counts the first k terms dominate all others.
    order = order[np.arange(len(order)) - starts[np.cumsum(new) - 1] < k]
    g, whole, place = group[order], lang_n[order], term[order]
    kept = []
    for own in np.split(np.arange(len(order)), np.flatnonzero(g[1:] != g[:-1]) + 1):
        band = own[:0]
        for at in range(0, len(own), 256):
            rows = own[at : at + 256]
            # Dominating rows come earlier, and those of the band suffice to see that there are k.
            before = np.concatenate([band, rows])
            over = (whole[before] <= whole[rows][:, None]) & (place[before] < place[rows][:, None])
            over[:, len(band) :] &= np.tri(len(rows), k=-1, dtype=bool)
            band = np.concatenate([band, rows[over.sum(axis=1) < k]])
        kept.append(band)
    return order[np.concatenate(kept)] if kept else order


def _band_of(table: pa.Table, k: int) -> pa.Table:
    if not table.num_rows:
        return table
    keys = [pc.rank(table.column(c).combine_chunks(), tiebreaker="dense").to_numpy().astype(np.int64) for c in ("lang", "source", "term")]
    group = keys[0] * (keys[1].max() + 1) + keys[1]
    return table.take(pa.array(skyband(group, table.column("n").to_numpy(), table.column("lang_n").to_numpy(), keys[2], k)))


def skybands(kept: DataFrame, k: int) -> DataFrame:
    """(lang, source, term, n, lang_n): the k-skyband of each group, merged from those of the partitions."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        band, new, rows = None, [], 0

        def merged() -> pa.Table:
            return _band_of(pa.Table.from_batches(new) if band is None else pa.concat_tables([band, pa.Table.from_batches(new)]), k)

        for batch in batches:
            new.append(batch)
            rows += batch.num_rows
            if rows > BAND_ROWS:
                band, new, rows = merged(), [], 0
        if new:
            band = merged()
        if band is not None:
            part = pa.array(np.full(band.num_rows, context.partitionId()), pa.int32())
            yield from band.append_column("part", part).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        return _band_of(table, k)

    source = kept.select("lang", "source", "term", "n", "lang_n")
    bands, parts = stored(source.mapInArrow(local, _BAND), "bands"), None
    parts = (bands.agg(F.max("part").alias("m")).first()["m"] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        bands = bands.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("lang", "source", "part").applyInArrow(
            lambda table: merge(table), _BAND
        )
    return bands.drop("part")


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of f over the terms of a cell for the pairs (source < other) that have one end in each block."""
    sources = right.column("source").to_pylist()
    number = {s: i for i, s in enumerate(sources)}
    block = right.column("block").to_numpy()
    lo, hi = right.column("lo")[0].as_py(), right.column("hi")[0].as_py()
    whole = right.column("whole").to_numpy()
    sums, terms = np.zeros((len(sources), len(sources)), np.int64), 0
    if left.num_rows:
        term = left.column("term").combine_chunks().dictionary_encode()
        row, terms = term.indices.to_numpy().astype(np.int64), len(term.dictionary)
        column = np.array([number[s] for s in left.column("source").to_pylist()])
        count = left.column("n").to_numpy()
        order = np.argsort(row, kind="stable")
        row, column, count = row[order], column[order], count[order]
        for at in range(0, terms, MATRIX_TERMS):
            a, b = np.searchsorted(row, [at, at + MATRIX_TERMS])
            dense = np.zeros((min(MATRIX_TERMS, terms - at), len(sources)), np.int64)
            dense[row[a:b] - at, column[a:b]] = count[a:b]
            p = shares(dense, whole[None, :])
            for i in range(len(sources) - 1):
                own, other = p[:, i : i + 1], p[:, i + 1 :]
                gap = other - own
                sums[i, i + 1 :] += (gap * gap // (other + own)).sum(axis=0)
    first, second = np.triu_indices(len(sources), 1)
    some = ((block[first] == lo) & (block[second] == hi)) | ((block[first] == hi) & (block[second] == lo))
    first, second = first[some], second[some]
    names = pa.array(sources, pa.string())
    return pa.table({
        "lang": pa.array([right.column("lang")[0].as_py()] * len(first), pa.string()),
        "source": names.take(pa.array(first)), "other": names.take(pa.array(second)),
        "value": pa.array(sums[first, second], pa.int64()), "terms": pa.array(np.full(len(first), terms), pa.int64()),
    })


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) for all ordered pairs of sources of a lang."""
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    blocks = max(1, -(-sizes // BLOCK_SOURCES))
    cells = max(1, -(-kept.count() // CELL_ROWS))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def with_blocks(df: DataFrame) -> DataFrame:
        met = df.withColumn("block", block).withColumn("met", others)
        return met.withColumns({"lo": F.least("block", "met"), "hi": F.greatest("block", "met")}).drop("met")

    left = with_blocks(kept.select("lang", "source", "term", "n")).withColumn("cell", F.pmod(F.xxhash64("term"), F.lit(cells)))
    whole = F.greatest(F.col("total") + 2 * F.col("terms"), F.lit(1))
    right = with_blocks(groups.select("lang", "source", whole.alias("whole"))).withColumn(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")))
    )
    key = ["lang", "lo", "hi", "cell"]
    summed = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda a, b: _pairs(a, b), "lang string, source string, other string, value long, terms long"
    ).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("held"))
    mine = groups.select("lang", "source", "terms", F.col("zero").alias("p"))
    theirs = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("q"))
    both = summed.join(mine, ["lang", "source"]).join(theirs, ["lang", "other"])
    value = F.when(F.col("terms") > 0, F.col("value") + (F.col("terms") - F.col("held")) * differ(F.col("p"), F.col("q"))).otherwise(0)
    one = both.select("lang", "source", "other", value.alias("value"))
    return one.unionByName(one.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))


def audit(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, k: int = TOP,
) -> DataFrame:
    """lang, source, part, item, value, rank."""
    counted = stored(count_terms(df, text_col, lang_col, source_col), "counted")
    terms = counted.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")
    ).where(F.col("docs") >= min_docs).drop("docs")
    kept = stored(counted.where("n > 0").drop("docs").join(terms, ["lang", "term"]), "kept")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.countDistinct("term").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = counted.where("term IS NULL").select("lang", "source")
    groups = known.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "terms"])
    groups = stored(groups.withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(1)), "groups")

    judged = skybands(kept, k).join(groups.drop("zero"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    found = judged.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    own_terms = found.select("lang", "source", F.lit("term").alias("part"), "item", differ(F.col("p"), F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(order)
    ).where(F.col("rank") <= k)
    pairs = source_pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(own_terms).withColumn("rank", F.col("rank").cast("int"))
