"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct five-word shingles (ASCII letters lower-cased, words between ASCII white space; a
shorter document is one shingle of all its words). 256 minima per set give

* band keys: groups of minima, as large as the threshold allows. With 42 groups of six, sets with a Jaccard similarity of 0.85
  share no key with a probability of 2e-9; with 51 groups of five, sets with 0.8 with one of 2e-9;
* a packed signature: the two low bits of each (mixed) minimum. Two signatures agree at a minimum with probability
  ``J + (1 - J) / 4``, so a bit count gives an estimate corrected for chance agreement. Pairs whose estimate is over six
  standard deviations below the threshold are given up; all others are confirmed on the full sets.

The threshold is a parameter (85 unless given); ``limits_of`` derives bands and signature limit from it.

Documents with equal sets are one class with the smallest id as representative. Candidates are worked off so that a large
group of near copies does not become a table of all its pairs. First every member of a band bucket is compared with the
bucket's smallest representative; the found links form components. Only members of one bucket that are still in
different components remain. They are compared inside tasks, in blocks bounded by members and bytes, each pair of blocks a group: by signatures
first, which leaves the members that have a likely partner, and those by their full sets. A task returns no pairs but
the links that join components it has not joined yet. A pair is compared in the first bucket that it shares. A link
between two classes of one component adds nothing, so the components are those of all links among candidates.

Per row: n_shingles, component_id (smallest id reachable over links), kept (id = component_id). Defined cases: without words
a document has no shingles and is linked with nothing; a row without id is linked with nothing and kept; rows with the same id
and set are one document; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from math import sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import add_columns, fresh, list_array, slices, texts_of
from .components import components, stored
from .repeats import mix
from .words import Words

SHINGLE = 5
# Links need 100 * shared >= threshold * union.
THRESHOLD = 85
HASHES = 256
WORDS = HASHES * 2 // 64
# The most likely that a pair at the threshold shares no band, and the deviations that its signature may be off.
MISSED, DEVIATIONS = 1e-8, 6.4

# Members of a bucket that are compared in one go, and rows of small buckets for a group; the same in bytes.
BLOCK = 1024
TASK_ROWS = 4096
BLOCK_BYTES = 8 << 20
TASK_BYTES = 32 << 20

_seed = np.random.RandomState(20240601)
_XOR = _seed.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_FACTOR = _seed.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


class Limits(NamedTuple):
    threshold: int
    rows: int
    bands: int
    # Pairs with more disagreeing minima are given up.
    most_different: int


@lru_cache
def limits_of(threshold: int) -> Limits:
    """The largest bands that find a pair at the threshold, and the most minima in which its signatures disagree."""
    similar = threshold / 100
    rows = max((r for r in range(1, HASHES + 1) if (1 - similar**r) ** (HASHES // r) <= MISSED), default=1)
    chance = 0.75 * (1 - similar)
    most = HASHES * chance + DEVIATIONS * sqrt(HASHES * chance * (1 - chance))
    return Limits(threshold, rows, HASHES // rows, int(most))


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    words = Words([t.encode("utf-8", "replace").lower() for t in texts])
    hashes, out = words.hashes(), []
    for begin, end in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True):
        size = min(SHINGLE, end - begin)
        if not size:
            out.append(np.empty(0, np.uint64))
            continue
        last = end - size + 1
        found = hashes[begin:last]
        for k in range(1, size):
            found = mix(found, hashes[begin + k : last + k])
        # The length is part of a short document's shingle.
        out.append(np.unique(mix(found, np.full(len(found), size, np.uint64))))
    return out


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of each of the HASHES hash functions."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(values), 512):
        least = np.minimum(least, ((values[start : start + 512, None] ^ _XOR) * _FACTOR).min(axis=0))
    return least


def signature(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, packed into 64-bit words."""
    bits = (((least ^ (least >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64)
    shifts = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(bits.reshape(WORDS, 32) << shifts, axis=1).view(np.int64)


def band_keys(least: np.ndarray, limits: Limits) -> np.ndarray:
    groups = least[: limits.bands * limits.rows].reshape(limits.bands, limits.rows).astype(np.uint64)
    key = np.arange(limits.bands, dtype=np.uint64)
    for k in range(limits.rows):
        key = mix(key, groups[:, k])
    return key.view(np.int64)


def sign(df: DataFrame, limits: Limits, text_col: str = "text") -> DataFrame:
    """Append n_shingles, set_a and set_b (a 128-bit identifier of the set), bands and signature."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        sizes, one, two, bands, packed = [], [], [], [], []
        for found in shingles(texts_of(part.column(text_col))):
            least = minima(found)
            sizes.append(len(found))
            one.append(int(np.add.reduce(mix(found, found)).view(np.int64)) if len(found) else 0)
            two.append(int(np.add.reduce(mix(found, ~found)).view(np.int64)) if len(found) else 0)
            bands.append(band_keys(least, limits))
            packed.append(signature(least))
        values = np.concatenate(bands) if bands else np.empty(0, np.int64)
        words = np.concatenate(packed) if packed else np.empty(0, np.int64)
        return [
            pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
            list_array([limits.bands] * len(sizes), pa.array(values)), list_array([WORDS] * len(sizes), pa.array(words)),
        ]

    longs = T.ArrayType(T.LongType())
    return add_columns(df, text_col, [
        T.StructField("n_shingles", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
        T.StructField("bands", longs), T.StructField("signature", longs),
    ], work)


def different(a: Column, b: Column) -> Column:
    """How many minima of two packed signatures disagree."""
    low = F.lit(0x5555555555555555)
    counts = []
    for k in range(WORDS):
        x = a[k].bitwiseXOR(b[k])
        counts.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def estimated_similarity(a: Column, b: Column) -> Column:
    """Agreement of two signatures, corrected for agreement by chance."""
    return (1 - different(a, b) / F.lit(HASHES) - F.lit(0.25)) / F.lit(0.75)


def _may_link(n_a: Column, n_b: Column, sig_a: Column, sig_b: Column, limits: Limits) -> Column:
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * limits.threshold
    return sizes & (different(sig_a, sig_b) <= limits.most_different)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(run, pairs.select("a", "b").schema)


def _within_buckets(rows: DataFrame, work: Callable[[pa.Table], Iterator[tuple]], names: tuple[str, str]) -> DataFrame:
    """Apply ``work`` to the members of each bucket; a bucket over BLOCK members or BLOCK_BYTES is met block by block.

    A member of a bucket of k blocks goes to the k pairs of blocks it is part of, and each pair is a group of its own. Buckets
    of one block share groups.
    """
    # What a row takes: its bands and signature, and its full set where it comes along.
    held = F.lit(8) * (F.size("bands") + F.size("sig")) + (F.length("shingles") if "shingles" in rows.columns else F.lit(0))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(held) / BLOCK_BYTES)).cast("int")
    sizes = stored(rows.groupBy("bucket").agg(
        blocks.alias("blocks"), F.count("*").alias("rows"), F.sum(held).alias("bytes")
    ), "bucket_sizes")
    small = sizes.where("blocks = 1").agg(
        F.greatest(F.ceil(F.sum("rows") / TASK_ROWS), F.ceil(F.sum("bytes") / TASK_BYTES))
    ).first()[0]
    met = rows.join(sizes.select("bucket", "blocks"), "bucket").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    )
    shared = F.col("blocks") == 1
    parts = {
        "part": F.when(shared, F.pmod(F.xxhash64("bucket"), F.lit(max(1, small or 0)))).otherwise(F.col("bucket")),
        "part_one": F.when(shared, -1).otherwise(F.col("one")), "part_two": F.when(shared, -1).otherwise(F.col("two")),
    }
    kinds = {"bucket": T.LongType(), "rep": rows.schema["rep"].dataType, "a": rows.schema["rep"].dataType, "b": rows.schema["rep"].dataType}
    schema = T.StructType([T.StructField(n, kinds[n]) for n in names])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending"), ("one", "ascending"), ("two", "ascending")]).combine_chunks()
        keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "one", "two")], axis=1)
        cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])).tolist() + [len(keys)]
        found = [row for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1 for row in work(table.slice(a, b - a))]
        return pa.table([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], names=list(names))

    dealt = met.withColumns(parts).drop("blocks", "other")
    return dealt.groupBy(*parts).applyInArrow(lambda table: run(table), schema)


def _likely_pairs(table: pa.Table, limits: Limits) -> Iterator[tuple[int, np.ndarray]]:
    """Members of a bucket, each with the later ones in other components that may be linked to it.

    Of two different blocks only pairs across are looked at, and of each pair only the first bucket that it shares.
    """
    component = table.column("component").to_numpy(zero_copy_only=False)
    size, block = table.column("n").to_numpy(), table.column("block").to_numpy()
    sig = np.stack(table.column("sig").to_numpy(zero_copy_only=False)).view(np.uint64)
    bands = np.stack(table.column("bands").to_numpy(zero_copy_only=False))
    across = table.column("one")[0] != table.column("two")[0]
    here = (bands == table.column("bucket")[0].as_py()).argmax(axis=1)
    low = np.uint64(0x5555555555555555)
    for x in range(len(size) - 1):
        y = np.arange(x + 1, len(size))
        y = y[component[y] != component[x]]
        if across:
            y = y[block[y] != block[x]]
        y = y[np.minimum(size[y], size[x]) * 100 >= np.maximum(size[y], size[x]) * limits.threshold]
        unequal = sig[y] ^ sig[x]
        y = y[np.bitwise_count((unequal | (unequal >> np.uint64(1))) & low).sum(axis=1) <= limits.most_different]
        y = y[(bands[y] == bands[x]).argmax(axis=1) == here[x]]
        if len(y):
            yield x, y


def _likely_members(table: pa.Table, limits: Limits) -> Iterator[tuple]:
    """(bucket, representative) of the members that have a likely partner."""
    hit = np.zeros(table.num_rows, bool)
    for x, y in _likely_pairs(table, limits):
        hit[x] = True
        hit[y] = True
    bucket, rep = table.column("bucket")[0].as_py(), table.column("rep").to_pylist()
    return iter([(bucket, rep[k]) for k in np.flatnonzero(hit)])


def _joining_links(table: pa.Table, limits: Limits) -> Iterator[tuple]:
    """Confirmed links of a bucket, of those inside one growing component only the first."""
    rep, start = table.column("rep").to_pylist(), table.column("component").to_pylist()
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles")]
    parent = {c: c for c in start}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for x, partners in _likely_pairs(table, limits):
        own = sets[x]
        for y in partners.tolist():
            one, two = root(start[x]), root(start[y])
            if one == two:
                continue
            other = sets[y]
            at = np.searchsorted(own, other)
            at[at == len(own)] = 0
            shared = int((own[at] == other).sum())
            if 100 * shared >= limits.threshold * (len(own) + len(other) - shared):
                parent[max(one, two)] = min(one, two)
                yield rep[x], rep[y]


def _sets(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The full shingle sets of some representatives."""
    wanted = docs.join(reps, docs["rep"] == reps["node"], "left_semi").select("rep", text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                raw = [s.tobytes() for s in shingles(texts_of(part.column(text_col)))]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(raw, pa.binary())], names=["rep", "shingles"])

    fields = [T.StructField("rep", docs.schema["rep"].dataType), T.StructField("shingles", T.BinaryType())]
    # Rows that repeat an id have the same set; one is enough.
    return wanted.mapInArrow(run, T.StructType(fields)).dropDuplicates(["rep"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Append n_shingles, component_id and kept to every row; links need ``threshold`` hundredths of the union."""
    limits = limits_of(threshold)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    signed = stored(sign(texts, limits).drop("text"), "signatures")
    classes = (
        signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_a", "set_b")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
             F.first("signature").alias("sig"))
    )
    keys = classes.select("rep", "n", "sig", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    # Only representatives that meet another one stay; all later steps work on these.
    members = stored(keys.select("rep", "bucket").join(shared.select("bucket"), "bucket"), "members")
    nodes = members.select(F.col("rep").alias("node")).distinct()
    known = stored(classes.join(nodes, F.col("rep") == F.col("node"), "left_semi").select("rep", "n", "sig", "bands"), "classes")
    sets = stored(_sets(df.select(F.col(id_col).alias("rep"), text_col), nodes, id_col, text_col), "sets")
    one, two = (known.select(*[F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "sig")]) for k in ("a", "b"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        likely = pairs.join(one, F.col("a") == F.col("rep_a")).join(two, F.col("b") == F.col("rep_b")).where(
            _may_link(F.col("n_a"), F.col("n_b"), F.col("sig_a"), F.col("sig_b"), limits)
        )
        return _confirmed(likely.select("a", "b"), sets, threshold)

    heads = members.groupBy("bucket").agg(F.min("rep").alias("head"))
    pairs = members.join(heads, "bucket").where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b"))
    links = stored(confirmed(pairs), "confirmed")
    grouped = components(links)
    labelled = stored(members.join(grouped, members["rep"] == grouped["node"], "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    ), "labelled")
    split = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = labelled.join(split.select("bucket"), "bucket")
    likely = stored(_within_buckets(
        open_.join(known, "rep"), partial(_likely_members, limits=limits), ("bucket", "rep")
    ), "likely")
    last = stored(_within_buckets(
        open_.join(likely.distinct(), ["bucket", "rep"]).join(known, "rep").join(sets, "rep"), partial(_joining_links, limits=limits), ("a", "b")
    ), "confirmed")
    grouped = components(links.unionByName(last))
    by_set = classes.join(grouped, F.col("rep") == F.col("node"), "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component_id")
    )
    results = signed.select("id", "text_key", "n_shingles", "set_a", "set_b").join(by_set, ["set_a", "set_b"], "left").select(
        "id", "text_key", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    return _attach(df, results, id_col, text_col)


def _attach(df: DataFrame, results: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Join the results to the rows by id and text, so that repeated rows find the one result they share."""
    kept = [c for c in df.columns if c.lower() not in ("n_shingles", "component_id", "kept")]
    key, row_id = fresh(df, "text_key"), fresh(df, "row_id")
    once = results.groupBy(F.col("id").alias(row_id), F.col("text_key").alias(key)).agg(
        F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id")
    )
    rows = df.select(*kept).withColumn(key, F.xxhash64(text_col))
    # A missing id stands for no document in particular: such rows are linked with nothing.
    return rows.join(once, F.col(id_col).eqNullSafe(F.col(row_id)) & (rows[key] == once[key]), "left").select(
        *kept, "n_shingles", F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)).alias("kept"),
    )
