"""Main text of web pages by wrapper induction.

1. *Pages.* Each page is read once into its block tree: a skeleton of labels (element, class and id words; repeats of neighbours
   folded into one) and its text blocks. Blocks in elements that are no main text by kind or name (menus, headers, footers,
   sidebars, notices, adverts, forms, comments) are no candidates; if the page marks an article, only blocks in it are.
2. *Templates.* The distinct skeletons of a host are aligned by simple tree matching, the most frequent first, into one
   template tree. Skeletons are dealt into cells of bounded size, whose templates are merged in the same way, so a host may have
   any number of pages.
3. *Slots.* Every skeleton is aligned with its host's template; a block's slot is the template node it falls on. A text that
   comes back in a slot on most of the host's pages is a constant node: template, not content. So are slots that mostly
   hold links. Everything else is a varying slot: content.
4. *Text.* The blocks of varying slots, in page order.

Only pages that differ in their candidate text count for step 3, so copies of an article do not make it constant, and it takes
MIN_PAGES of them; hosts with fewer pages are judged by steps 1 and 4. Outside of a marked article a text is constant if it
comes back on half of the pages that have its slot; inside on nine tenths of all pages of the host, so that neither a common
line nor a large group of near copies of one article passes for a template. Skeletons, slots and constants are counted by
Spark; a host's pages never meet in one task.

White space inside a block, line breaks included, becomes one space; cells of a table row are one block.

Defined cases: null or empty html gives an empty text; rows that repeat each give theirs; pages without a host in the url
are judged alone; unclosed and crossing elements are closed as browsers do; unfinished comments and scripts reach to the end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import fresh, slices, texts_of
from .components import stored
from .dom import Page, Tree, absorb, align

MIN_PAGES = 5
# Skeletons or templates that one task aligns into one.
CELL_TREES = 400
FAN_IN = 32
# Wrappers up to this size are sent to all tasks; beyond it they are joined by key.
BROADCAST_BYTES = 16 << 20
SALTS = 16

_BLOCKS = T.ArrayType(T.StructType([
    T.StructField("node", T.IntegerType()), T.StructField("text", T.StringType()),
    T.StructField("links", T.IntegerType()), T.StructField("zone", T.IntegerType()),
]))


def host_of(url: Column) -> Column:
    """The lower-cased host of an absolute URL, '' if there is none."""
    name = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(name)


def read_pages(df: DataFrame, html_col: str, skeleton: str, blocks: str) -> DataFrame:
    """Replace the html column by the page's skeleton (JSON) and its candidate blocks."""
    kept = [f for f in df.schema.fields if f.name != html_col]
    names = [f.name for f in kept] + [skeleton, blocks]
    block_type = to_arrow_type(_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_col):
                trees, found = [], []
                for source in texts_of(part.column(html_col)):
                    page = Page(source)
                    tree, number = page.skeleton()
                    trees.append(json.dumps(tree, ensure_ascii=False, separators=(",", ":")))
                    found.append([
                        {"node": number[node], "text": text, "links": links, "zone": zone}
                        for text, links, node, zone in zip(page.texts, page.links, page.owner, page.zones(), strict=True) if zone
                    ])
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + [pa.array(trees, pa.string()), pa.array(found, block_type)], names=names,
                )

    fields = [T.StructField(skeleton, T.StringType()), T.StructField(blocks, _BLOCKS)]
    return df.mapInArrow(run, T.StructType(kept + fields))


def _merged(forms: list[tuple[int, Tree]]) -> str:
    trees = [tree for _, tree in forms]
    template = trees[0]
    for tree in trees[1:]:
        absorb(template, tree)
    return json.dumps(template.form(), ensure_ascii=False, separators=(",", ":"))


def induce(shapes: DataFrame) -> DataFrame:
    """(host, template) from distinct (host, skeleton, pages, cell)."""

    def first(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("pages").to_pylist(), table.column("skeleton").to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
        return out(table, _merged([(n, Tree.of(json.loads(s), n)) for n, s in rows]))

    def again(table: pa.Table) -> pa.Table:
        forms = sorted(table.column("template").to_pylist())
        trees = sorted(((Tree.read(json.loads(f))) for f in forms), key=lambda t: -t.weight)
        return out(table, _merged([(t.weight, t) for t in trees]))

    def out(table: pa.Table, template: str) -> pa.Table:
        return pa.table({
            "host": pa.array([table.column("host")[0].as_py()], pa.string()),
            "cell": pa.array([table.column("cell")[0].as_py()], pa.int64()), "template": pa.array([template], pa.string()),
        })

    schema = "host string, cell long, template string"
    cells = shapes.agg(F.max("cell").alias("m")).first()["m"] or 0
    templates = shapes.groupBy("host", "cell").applyInArrow(lambda table: first(table), schema)
    while cells:
        cells //= FAN_IN
        moved = templates.withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("long"))
        templates = moved.groupBy("host", "cell").applyInArrow(lambda table: again(table), schema)
    return templates.drop("cell")


def place(shapes: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, shape, node, slot): where the nodes of each skeleton fall on the template of their host."""

    def run(own: pa.Table, template: pa.Table) -> pa.Table:
        shape, node, slot = [], [], []
        if own.num_rows:
            root = Tree.read(json.loads(template.column("template")[0].as_py())).numbered()
            for name, skeleton in zip(own.column("shape").to_pylist(), own.column("skeleton").to_pylist(), strict=True):
                pairs: list[tuple[Tree, Tree]] = []
                align(root, Tree.of(json.loads(skeleton), 0).numbered(), pairs)
                shape += [name] * len(pairs)
                node += [y.number for _, y in pairs]
                slot += [x.number for x, _ in pairs]
        host = template.column("host")[0].as_py() if template.num_rows else ""
        return pa.table({
            "host": pa.array([host] * len(shape), pa.string()), "shape": pa.array(shape, pa.string()),
            "node": pa.array(node, pa.int32()), "slot": pa.array(slot, pa.int32()),
        })

    cells = shapes.groupBy("host").agg(F.max("cell").alias("m"))
    copies = templates.join(cells, "host").select("host", "template", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("cell"))
    return shapes.groupBy("host", "cell").cogroup(copies.groupBy("host", "cell")).applyInArrow(
        lambda a, b: run(a, b), "host string, shape string, node int, slot int"
    )


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, shape, constants, menus): what a page of this shape has to drop, from pages (host, skeleton, blocks)."""
    known = pages.where("host <> ''").withColumn("shape", F.md5("skeleton"))
    voice = F.xxhash64(F.transform("blocks", lambda b: b["text"]))
    held = known.select("host", "shape", voice.alias("voice"), F.explode("blocks").alias("b")).select(
        "host", "shape", "voice", "b.node", "b.zone", "b.links", F.xxhash64("b.text").alias("text"), F.length("b.text").alias("chars"),
    )
    hosts = known.groupBy("host").agg(F.countDistinct(voice).alias("voices")).where(F.col("voices") >= MIN_PAGES)

    shapes = known.groupBy("host", "shape").agg(F.first("skeleton").alias("skeleton"), F.count("*").alias("pages")).join(hosts.select("host"), "host")
    sizes = shapes.groupBy("host").agg(F.ceil(F.count("*") / CELL_TREES).alias("cells"))
    shapes = stored(shapes.join(sizes, "host").withColumn("cell", F.pmod(F.xxhash64("shape"), "cells")).drop("cells"), "shapes")
    slots = stored(place(shapes, induce(shapes)), "slots")

    # Texts are counted per shape first, so that slots are looked up for counts and not for pages.
    seen = held.groupBy("host", "shape", "node", "zone", "text", "voice").agg(F.sum("links").alias("links"), F.sum("chars").alias("chars"))
    seen = stored(seen.join(slots, ["host", "shape", "node"]), "seen")
    per_slot = seen.groupBy("host", "slot").agg(
        F.countDistinct("voice").alias("slot_voices"), F.sum("links").alias("links"), F.sum("chars").alias("chars")
    )
    texts = seen.groupBy("host", "slot", "zone", "text").agg(F.countDistinct("voice").alias("n")).where(F.col("n") >= MIN_PAGES)
    constant = F.when(F.col("zone") == 1, 10 * F.col("n") >= 9 * F.col("voices")).otherwise(2 * F.col("n") >= F.col("slot_voices"))
    constants = texts.join(per_slot.drop("links", "chars"), ["host", "slot"]).join(hosts, "host").where(constant)
    menus = per_slot.where((F.col("slot_voices") >= MIN_PAGES) & (2 * F.col("links") > F.col("chars")))
    dropped = slots.join(constants.select("host", "slot", "text"), ["host", "slot"]).groupBy("host", "shape").agg(
        F.collect_set(F.struct("node", "text")).alias("constants")
    )
    linked = slots.join(menus.select("host", "slot"), ["host", "slot"]).groupBy("host", "shape").agg(F.collect_set("node").alias("menus"))
    return stored(dropped.join(linked, ["host", "shape"], "full"), "wrappers")


def _with_wrappers(pages: DataFrame, made: DataFrame, salt: str) -> DataFrame:
    """Pages with their wrapper, by broadcast if that is small, else by a join in which a host's pages are spread."""
    entries = F.coalesce(F.size("constants"), F.lit(0)) * 16 + F.coalesce(F.size("menus"), F.lit(0)) * 8 + F.length("host") + 64
    size = made.agg(F.sum(entries).alias("n")).first()["n"] or 0
    key = ["host", "shape"]
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(made), key, "left")
    copies = made.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = pages.withColumn(salt, F.pmod(F.xxhash64("blocks"), F.lit(SALTS)).cast("int"))
    return spread.join(copies, [*key, salt], "left").drop(salt)


def extract(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The columns of ``df`` without the html, and text and n_chars; same-named columns are replaced."""
    own = df.drop(*[c for c in df.columns if c.lower() in ("text", "n_chars") and c not in (url_col, html_col)])
    names = [c for c in own.columns if c != html_col]
    # Given columns travel as one, so that none can clash with a name used here.
    rows = own.select(F.struct(*names).alias("given"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    pages = stored(read_pages(rows, "html", "skeleton", "blocks"), "pages")
    made = wrappers(pages)
    judged = _with_wrappers(pages.withColumn("shape", F.md5("skeleton")), made, "salt")

    def content(b: Column) -> Column:
        constant = F.array_contains("constants", F.struct(b["node"].alias("node"), F.xxhash64(b["text"]).alias("text")))
        # A slot known to the host is judged by all its pages, another by this block.
        menu = F.coalesce(F.array_contains("menus", b["node"]), F.lit(False)) | (2 * b["links"] > F.length(b["text"]))
        return ~F.coalesce(constant, F.lit(False)) & ~((b["zone"] == 2) & menu)

    text = F.array_join(F.transform(F.filter("blocks", content), lambda b: b["text"]), "\n")
    out = judged.select("given.*", text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
