"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A text's paragraphs (lines, each distinct one once) are hashed to 64-bit digests. A table has
``GROUPS`` groups of ``CELLS`` cells; a digest goes to one cell of each group, and a cell holds the
number of its digests, their XOR and the XOR of their checks. Tables of two texts subtract cell by
cell, which leaves the digests only one of them has; peeling takes a cell with a single digest,
removes that digest from its other cells, and goes on until all cells are empty. The number of
digests found gives the likeness of the paragraph sets (Jaccard). If cells remain, both tables are
made anew with more room: digests are dealt over ``2 ** n`` tables by other hash bits, as rows of
their own, and twice as many until every table peels.

Only DataFrame functions run here. At scale: a text moves once, to a bucket that follows doc_id and
gets the first text of the next bucket as well, so "the next document" needs no global sort. Retries
move 8-byte digests, and a row never holds more than one small table's worth of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotwise.llm.frames import key_and_text, original_id, parts_for
from slotwise.llm.order import bucket_bounds, bucket_of
from slotwise.session import materialise

GROUPS, CELLS = 3, 8
LOAD = 6  # digests per table to aim at when retrying
ROUNDS = 12
BUCKET_MB = 8
CELL = "struct<n:int,k:bigint,h:bigint>"


def digests(text: Column) -> Column:
    """64-bit digests of the distinct lines of a text."""
    return F.array_distinct(F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _place(key: Column, group: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1_000 * salt + group)), F.lit(CELLS)).cast("int")


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), h.alias("h")).cast(CELL)


def _toggle(cell: Column, n: Column, key: Column) -> Column:
    return _cell(cell["n"] - n, cell["k"].bitwiseXOR(key), cell["h"].bitwiseXOR(_check(key)))


_EMPTY = lambda: _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))


def table(keys: Column, salt: int = 0) -> Column:
    """Cells of the digests, group after group."""

    def group(g: int) -> Column:
        placed = F.transform(keys, lambda d: F.struct(_place(d, g, salt).alias("at"), d.alias("d")))
        own = lambda j: F.filter(placed, lambda x: x["at"] == j)
        return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda j: F.aggregate(own(j), _EMPTY(), lambda c, x: _toggle(c, F.lit(-1), x["d"])))

    return F.concat(*(group(g) for g in range(GROUPS)))


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))


def peeled(cells: Column, salt: int = 0) -> Column:
    """The number of digests in a difference, or null if peeling stops before all cells are empty."""

    def single(c):
        return (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"]))

    def step(state):
        found = F.array_distinct(F.transform(F.filter(state["cells"], single), lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"))))
        placed = F.transform(
            found, lambda x: F.struct(x["k"].alias("k"), x["n"].alias("n"), F.array(*(_place(x["k"], g, salt) + g * CELLS for g in range(GROUPS))).alias("at"))
        )

        def without(keys):
            return F.transform(
                state["cells"],
                lambda c, j: F.aggregate(F.filter(keys, lambda x: F.array_contains(x["at"], j)), c, lambda cell, x: _toggle(cell, x["n"], x["k"])),
            )

        return F.struct(without(placed).alias("cells"), (state["found"] + F.size(found)).cast("int").alias("found"), (F.size(found) == 0).alias("done"))

    kind = f"struct<cells:array<{CELL}>,found:int,done:boolean>"
    begin = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(False).alias("done")).cast(kind)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, lambda s, _: F.when(s["done"], s).otherwise(step(s).cast(kind)))
    clean = lambda s: F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["h"] == 0))
    # wrapped as a one-element array so that the peeling is written, and run, once
    return F.transform(F.array(end), lambda s: F.when(clean(s), s["found"]))[0]


def written(cells: Column) -> Column:
    """Cells as text: base64 of count (4 bytes), digests (8) and checks (4) of each."""
    hexed = F.transform(
        cells, lambda c: F.concat(F.lpad(F.hex(F.pmod(c["n"].cast("long"), F.lit(1 << 32))), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["h"]), 8, "0"))
    )
    return F.base64(F.unhex(F.array_join(hexed, "")))


def likeness(a: Column, b: Column, found: Column) -> Column:
    """Share of the paragraphs of both texts that both have, from their numbers and the differing ones."""
    return (a + b - found) / (a + b + found)


def _with_next(docs: DataFrame, bucket_mb: float) -> DataFrame:
    """``bucket, place, doc_id, text, next``: each text and that of the next doc_id (after the last: the first)."""
    bounds = bucket_bounds(docs.select("doc_id"), parts_for(docs, bucket_mb))
    dealt = docs.withColumn("bucket", bucket_of("doc_id", bounds).cast("long"))
    firsts = dealt.groupBy("bucket").agg(F.min("doc_id").alias("doc_id"))  # one row per bucket
    order = Window.orderBy("bucket")
    firsts = materialise(firsts.withColumn("to", F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy()))), "firsts")
    guests = dealt.join(F.broadcast(firsts.select("bucket", "doc_id", "to")), ["bucket", "doc_id"])
    one = Window.partitionBy("bucket").orderBy(F.xxhash64("text"))
    guests = guests.withColumn("n", F.row_number().over(one)).where("n = 1")
    guests = guests.select(F.col("to").alias("bucket"), "doc_id", "text", F.lit(True).alias("guest"))
    rows = dealt.select("bucket", "doc_id", "text", F.lit(False).alias("guest")).unionByName(guests)
    rows = rows.withColumn("digests", digests(F.col("text")))
    along = Window.partitionBy("bucket").orderBy("guest", "doc_id", F.xxhash64("text"))
    rows = rows.select("bucket", F.row_number().over(along).alias("place"), "doc_id", "text", "digests", "guest", F.lead("text").over(along).alias("next"), F.lead("digests").over(along).alias("next_digests"))
    return rows.where(~F.col("guest")).drop("guest")


def _retry(failed: DataFrame) -> DataFrame:
    """``bucket, place, kind, found`` for all rows of ``failed`` (these, ``a`` and ``b``)."""
    key, salt, done = ["bucket", "place", "kind"], 1, None
    left = materialise(failed.withColumn("tables", F.greatest(F.lit(1), F.ceil((F.size("a") + F.size("b")) / LOAD)).cast("long")), "sketch-retry")
    while not left.isEmpty():
        side = lambda name, mark: F.transform(name, lambda d: F.struct(F.lit(mark).alias("side"), d.alias("d")))
        rows = left.select(*key, "tables", F.explode(F.concat(side("a", 0), side("b", 1))).alias("x"))
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("x.d", F.lit(-salt)), F.col("tables")))
        own = lambda mark: F.collect_list(F.when(F.col("x.side") == mark, F.col("x.d")))
        small = dealt.groupBy(*key, "part").agg(own(0).alias("a"), own(1).alias("b"))
        cells = difference(table(F.col("a"), salt), table(F.col("b"), salt))
        tried = small.select(*key, peeled(cells, salt).alias("found"))
        tried = tried.groupBy(*key).agg(F.sum("found").alias("found"), F.bool_or(F.col("found").isNull()).alias("failed"))
        tried = materialise(tried, "sketch-peeled")
        good = tried.where(~F.col("failed")).select(*key, "found")
        done = good if done is None else done.unionByName(good)
        left = left.join(tried.where("failed").select(*key), key).withColumn("tables", F.col("tables") * 2)
        left, salt = materialise(left, "sketch-retry"), salt + 1
    return failed.select(*key, F.lit(None).cast("long").alias("found")).limit(0) if done is None else done


def fingerprints(docs: DataFrame, bucket_mb: float = BUCKET_MB) -> DataFrame:
    """Fingerprints of texts and of their edited versions, and how alike they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_paragraphs``, a row per input row. The edited text has the last half of its code
    points (rounded down) replaced by as many of the first ones of the next document, or all it has.

    Null text counts as empty: one empty paragraph. Null doc_ids come last. Rows that share a
    doc_id follow each other by the hash of their texts. Equal texts are alike to degree 1. Other
    columns are ignored. Empty table: empty result.
    """
    docs = key_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = _with_next(docs, bucket_mb)
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("half", F.floor(n / 2).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")), F.substring("next", F.lit(1), F.col("half")))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "bucket", "place", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "digests", "next_digests", digests(F.col("edited")).alias("edited_digests")
    )
    rows = rows.select("*", table(F.col("digests")).alias("own"), table(F.col("edited_digests")).alias("other"), table(F.col("next_digests")).alias("following"))
    rows = rows.select(
        "bucket", "place", "doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("other")).alias("edited_fingerprint"),
        "digests", "edited_digests", "next_digests",
        peeled(difference(F.col("own"), F.col("other"))).alias("found_edited"), peeled(difference(F.col("own"), F.col("following"))).alias("found_next"),
    )
    sizes = [F.size(c).alias(f"n_{c}") for c in ("digests", "edited_digests", "next_digests")]
    keep = lambda c, *found: F.when(F.greatest(*(F.col(f).isNull() for f in found)) if len(found) > 1 else F.col(found[0]).isNull(), F.col(c)).alias(c)
    made = materialise(
        rows.select(
            "bucket", "place", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "found_edited", "found_next", *sizes,
            keep("digests", "found_edited", "found_next"), keep("edited_digests", "found_edited"), keep("next_digests", "found_next"),
        ),
        "sketches",
    )
    failed = None
    for kind, b in (("edited", "edited_digests"), ("next", "next_digests")):
        part = made.where(F.col(f"found_{kind}").isNull()).select("bucket", "place", F.lit(kind).alias("kind"), F.col("digests").alias("a"), F.col(b).alias("b"))
        failed = part if failed is None else failed.unionByName(part)
    later = _retry(failed).groupBy("bucket", "place").agg(
        F.max(F.when(F.col("kind") == "edited", F.col("found"))).alias("late_edited"), F.max(F.when(F.col("kind") == "next", F.col("found"))).alias("late_next")
    )
    # The retried pairs have no proven bound: the same join at every size, never a broadcast.
    both = made.join(later.hint("merge"), ["bucket", "place"], "left")
    near = lambda kind: likeness(F.col("n_digests"), F.col(f"n_{kind}_digests"), F.coalesce(f"found_{kind}", f"late_{kind}")).alias(f"near_{kind}")
    return both.select(original_id(), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited"), near("next"), F.col("n_digests").alias("n_paragraphs"))
