r"""Document fingerprints: invertible Bloom lookup sketches, in DataFrame
functions only.

A text is the set of its paragraphs: its lines, a line of more than
``part_chars`` characters in parts of that length. A paragraph's digest is 60
bits of its MD5. A sketch is three rows of ``size`` cells (a power of two); each
digest lies in one cell of each row, at the place that 20 of its bits name. A
cell holds how many digests lie in it, their XOR, and the XOR of a check of each.

Two sketches of one size subtract cell by cell: what both texts hold cancels. A
cell with a count of 1 or -1 whose check fits holds a single digest, of the first
or the second text; taking it out of its two other cells lays more of them bare.
If that peeling empties the sketch, the digests found are all that differ. If it
does not, a larger sketch is tried, with room for all digests of both texts, then
larger ones still for the few left, until every pair is resolved; so the result
is exact. The first two sizes are peeled in one pass.

Peeling runs row of cells by row of cells (a digest lies in one cell of a row, so
no digest is taken out twice) as aggregates by pair, which stay in the partitions
that the pairs were dealt to; empty cells are not kept. Its work grows with the
number of digests, for very long texts too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctflow.llm.common import shared_folder, text_or_empty, written

ROWS, BASE = 3, 8
#: Least cells a row in the second try; passes over the rows of cells in one try.
ROOMY, PASSES = 32, 2
BITS, SHIFT = 60, 20
MASK, HALF, PRIME = (1 << BITS) - 1, (1 << BITS // 2) - 1, (1 << 31) - 1
#: Stands for no digest, so that a pair without a difference keeps a row.
NOTHING = -(1 << 62)
#: Digests a partition peels.
PER_PARTITION = 200_000


def digests(text: Column, part_chars: int = 160) -> Column:
    """The distinct 60-bit digests of a text's paragraphs (array of long)."""
    parts = F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{part_chars}}}"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.conv(F.substring(F.md5(p), 1, BITS // 4), 16, 10).cast("long")))


def check(digest: Column) -> Column:
    """31 bits that the XOR of several digests does not fit."""
    a, b = F.shiftright(digest, BITS // 2), digest.bitwiseAND(F.lit(HALF))
    return F.pmod(a * b + a + b, F.lit(PRIME))


def place(digest: Column, row: int, size: Column | int) -> Column:
    """The place of a digest among the ``size`` cells of a row."""
    turned = F.shiftright(digest, SHIFT * row).bitwiseOR(F.shiftleft(digest, BITS - SHIFT * row)) if row else digest
    return turned.bitwiseAND((size if isinstance(size, Column) else F.lit(size)) - F.lit(1).cast("long"))


def sketch(found: Column, size: int = BASE) -> Column:
    """The cells (n, k, c) of an array of digests, row after row."""

    def row(r: int) -> Column:
        def cell(p: Column) -> Column:
            held = F.filter(found, lambda d: place(d, r, size) == p)
            zero = F.lit(0).cast("long")
            keys = F.aggregate(held, zero, lambda a, d: a.bitwiseXOR(d))
            checks = F.aggregate(held, zero, lambda a, d: a.bitwiseXOR(check(d)))
            return F.struct(F.size(held).alias("n"), keys.alias("k"), checks.alias("c"))

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")), cell)

    return F.flatten(F.array(*[row(r) for r in range(ROWS)]))


def fingerprint(found: Column) -> Column:
    """The base sketch as text: the number of digests, a colon, and for each cell
    count, XOR and check, in hexadecimal."""
    cells = F.transform(sketch(found), lambda c: F.concat_ws(".", *[F.lower(F.hex(c[x].cast("long"))) for x in "nkc"]))
    return F.concat(F.size(found).cast("string"), F.lit(":"), F.array_join(cells, " "))


CELL = ("id", "try", "size", "cell")


def cells_of(pairs: DataFrame, sizes: tuple[Column, Column]) -> DataFrame:
    """The subtracted sketches of every pair (id, left, right) at two sizes."""
    both = F.concat("left", F.transform("right", lambda d: -d - 1), F.array(F.lit(NOTHING)))
    rows = pairs.select("id", sizes[0].cast("long").alias("s0"), sizes[1].cast("long").alias("s1"), F.explode(both).alias("v"))
    v = F.col("v")
    rows = rows.select("id", "s0", "s1", v, F.when(v >= 0, v).otherwise(-v - 1).alias("k"), F.when(v == NOTHING, 0).when(v >= 0, 1).otherwise(-1).alias("n"))

    def at(t: int, row: int) -> Column:
        size = F.col(f"s{t}")
        cell = F.when(v == NOTHING, v).otherwise(size * row + place(F.col("k"), row, size))
        return F.struct(F.lit(t).alias("try"), size.alias("size"), cell.alias("cell"))

    placed = rows.select("id", "k", "n", F.explode(F.array(*[at(t, r) for t in (0, 1) for r in range(ROWS)])).alias("at"))
    return together(placed.select("id", "at.*", F.col("n").cast("long").alias("n"), "k", check(F.col("k")).alias("c")))


def together(cells: DataFrame) -> DataFrame:
    """Equal cells as one; empty ones go. Cells below 0 are digests found."""
    zero = F.lit(0).cast("long")
    summed = cells.groupBy(*CELL).agg(
        F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")
    ).select(*CELL, "n", *[F.when(F.col("cell") >= 0, F.col(x)).otherwise(zero).alias(x) for x in "kc"])
    return summed.where((F.col("cell") < 0) | (F.col("n") != 0) | (F.col("k") != 0) | (F.col("c") != 0))


def peeled_once(cells: DataFrame, row: int) -> DataFrame:
    """Takes the digests that stand alone in a cell of ``row`` out of the sketch;
    a digest found is the cell -1 - digest, its count says whose it is."""
    cell, n, k, c, size = (F.col(x) for x in ("cell", "n", "k", "c", "size"))
    zero = F.lit(0).cast("long")
    alone = (F.abs(n) == 1) & (k >= 0) & (cell == size * row + place(k, row, size)) & (c == check(k))

    def entry(cell: Column, n: Column, k: Column, c: Column) -> Column:
        return F.struct(cell.alias("cell"), n.alias("n"), k.alias("k"), c.alias("c"))

    others = [entry(size * r + place(k, r, size), -n, k, c) for r in range(ROWS) if r != row]
    after = F.when(alone, F.array(entry(-k - 1, n, zero, zero), *others)).otherwise(F.array(entry(cell, n, k, c)))
    return together(cells.select("id", "try", "size", F.explode(after).alias("e")).select("id", "try", "size", "e.*"))


def tried(pairs: DataFrame, sizes: tuple[Column, Column], listed: bool) -> DataFrame:
    """Per pair: ``size`` of the smaller sketch that peeling emptied (null if
    none), and what it gave."""
    cells = cells_of(pairs, sizes)
    for _ in range(PASSES):
        for row in range(ROWS):
            cells = peeled_once(cells, row)
    cell, n = F.col("cell"), F.col("n")
    per_try = cells.groupBy("id", "try", "size").agg(
        F.max(F.when(cell >= 0, 1).otherwise(0)).alias("left_over"),
        F.sum(F.when((cell < 0) & (n > 0), 1).otherwise(0)).alias("n_left"),
        F.sum(F.when((cell < 0) & (n < 0), 1).otherwise(0)).alias("n_right"),
        *[F.sort_array(F.collect_list(F.when((cell < 0) & (sign * n > 0), -cell - 1))).alias(name)
          for name, sign in (("only_left", 1), ("only_right", -1)) if listed],
    )
    found = [c for c in per_try.columns if c not in ("id", "try", "left_over")]
    done = F.when(F.col("left_over") == 0, F.struct("try", *found))
    return per_try.groupBy("id").agg(F.min(done).alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in found])


def differences(pairs: DataFrame, listed: bool = False) -> DataFrame:
    """Per pair of a stored table (``id``, unique; ``left``, ``right``: arrays of
    distinct digests): ``size``, the cells a row of the sketch that resolved it,
    ``n_left`` and ``n_right``, how many digests only one side holds, and with
    ``listed`` these digests themselves (``only_left``, ``only_right``, sorted).
    The result reads tables in the checkpoint folder."""
    spark = pairs.sparkSession
    total = F.size("left") + F.size("right")
    need = pairs.agg(F.coalesce(F.sum(total), F.lit(0))).head()[0]
    roomy = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(total, F.lit(ROOMY))))).cast("long")
    sizes, left, out = (F.lit(BASE), roomy), pairs, None
    while True:
        dealt = left.repartition(max(1, need // PER_PARTITION), "id")
        found = written(tried(dealt, sizes, listed), shared_folder(spark, "sketch-tried"))
        solved = found.where(F.col("size").isNotNull())
        out = solved if out is None else out.unionByName(solved)
        open_ids = found.where(F.col("size").isNull()).select("id")
        if open_ids.isEmpty():
            return out
        left = pairs.join(open_ids, "id", "left_semi")
        sizes = (sizes[1] * 2, sizes[1] * 4)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 1000, max_blocks: int = 50_000) -> DataFrame:
    """``id``, ``text`` and ``next_text``: the text of the next row in descending
    order of the id (missing ids last; equal ids by a hash of the text); after the
    last row comes the first.

    Texts are shuffled once. Rows whose key hashes to 0 modulo the block length
    are the bounds of blocks of ids; a block is sorted in one task, and the row
    before its first is sent to it too. At most about ``max_blocks`` bounds reach
    the driver. Rows equal in id and text follow one another, in one block.
    """
    hashed = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    key = F.struct("id", F.xxhash64("text").alias("h"))
    keys = hashed.select(key.alias("key"))
    every = max(rows_per_block, keys.count() // max_blocks)
    is_bound = F.pmod(F.xxhash64("key.h", "key.id"), F.lit(every)) == 0
    ends = keys.agg(F.sort_array(F.collect_set(F.when(is_bound, F.col("key")))).alias("bounds"), F.max("key").alias("last")).head()
    of_id = docs.schema[id_col].dataType.simpleString()

    def fixed(row) -> Column:
        return F.struct(F.lit(row["id"]).cast(of_id).alias("id"), F.lit(row["h"]).cast("long").alias("h"))

    bounds = F.array(*[fixed(b) for b in ends["bounds"]]) if ends["bounds"] else F.array().cast(f"array<struct<id:{of_id},h:bigint>>")
    powers = [1 << p for p in reversed(range(max(len(ends["bounds"]), 1).bit_length()))]
    below = F.aggregate(
        F.array(*[F.lit(p) for p in powers]), F.lit(0),
        lambda at, p: F.when(F.get(bounds, at + p - 1) < F.col("key"), at + p).otherwise(at),
    )
    placed = hashed.withColumn("key", key).withColumn("below", below)

    def sent(block: Column, own: int) -> Column:
        return F.struct(block.alias("block"), F.lit(own).alias("own"))

    is_last = F.get(bounds, F.col("below")).eqNullSafe(F.col("key"))
    wraps = F.col("key").eqNullSafe(fixed(ends["last"])) if ends["last"] is not None else F.lit(False)
    to = F.array(sent(F.col("below"), 1), F.when(is_last, sent(F.col("below") + 1, 0)), F.when(wraps, sent(F.lit(0), 0)))
    dealt = placed.select("key", "text", F.explode(F.filter(to, lambda x: x.isNotNull())).alias("to")).select("key", "text", "to.*")
    before = Window.partitionBy("block").orderBy("own", "key")
    return dealt.withColumn("next_text", F.lag("text").over(before)).where("own = 1").select(F.col("key.id").alias("id"), "text", "next_text")


def likeness(n: Column, m: Column, n_left: Column, n_right: Column) -> Column:
    """Twice the shared digests over all digests of both texts; 1 for two empty ones."""
    return F.when(n + m == 0, 1.0).otherwise((n + m - n_left - n_right) / (n + m))


def version_fingerprints(docs: DataFrame, part_chars: int = 160, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``. The edited text is
    the text with its last half replaced by as much of the next row's beginning.

    A null text is empty, and like any other empty text. A null id stays null.
    Repeats of a paragraph within a text do not count. Repeated rows are rows of
    their own. Other columns are not read. The result reads tables in the
    checkpoint folder.
    """
    spark = docs.sparkSession
    half = F.shiftright(F.length("text"), 1)
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    texts = with_next(docs, id_col, text_col).withColumn("edited", edited)
    rows = written(
        texts.select(
            F.monotonically_increasing_id().alias("row"), "id", F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            *[digests(F.col(f"{c}text" if c != "edited" else c), part_chars).alias(name) for c, name in (("", "own"), ("edited", "changed"), ("next_", "next"))],
        ),
        shared_folder(spark, "sketch-rows"),
    )
    sides = F.array(*[F.struct(F.lit(p).alias("p"), F.col(c).alias("right")) for p, c in enumerate(("changed", "next"))])
    pairs = rows.select("row", F.col("own").alias("left"), F.explode(sides).alias("s")).select(
        (F.col("row") * 2 + F.col("s.p")).alias("id"), "left", F.col("s.right").alias("right")
    )
    counts = (F.col(c) for c in ("n_left", "n_right"))
    apart = differences(pairs).select(F.shiftright("id", 1).alias("row"), F.col("id").bitwiseAND(F.lit(1)).alias("p"), *counts)

    def one(p: int, name: str) -> Column:
        return F.max(F.when(F.col("p") == p, F.col("n_left") + F.col("n_right"))).alias(name)

    by_row = written(apart.groupBy("row").agg(one(0, "d_changed"), one(1, "d_next")), shared_folder(spark, "sketch-apart"))
    sized = rows.select("row", "id", "n_chars", "edited_sha256", "own", "changed", F.size("next").alias("n_next"))
    zero = F.lit(0)
    return sized.join(by_row, "row").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.size("own"), F.size("changed"), F.col("d_changed"), zero).alias("near_edited"),
        likeness(F.size("own"), F.col("n_next"), F.col("d_next"), zero).alias("near_next"),
    )
