"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A text is the set of XXH64 digests of its pieces. Lines over ``LONG_LINE`` characters are cut after sentences, and
sentences over ``LONG_SENTENCE`` at words whose hash is the least among the ``RADIUS`` words on either side, so that
cuts depend on the words around them alone and an unchanged half of a text keeps its pieces.

A fingerprint has 2^k tables, one for at most ``TABLE_DIGESTS`` digests on average; a digest's first k bits choose its
table. A table has three rows of eight cells; each digest is in one cell of each row, and a cell has the number of its
digests, their exclusive or, and that of their checks. A fingerprint of k bits folds to one of fewer by adding cells,
so two are compared at the smaller size, where tables add up to those built from the digests. Subtracting
two tables cell by cell cancels what the texts share. Peeling recovers the rest: a cell of count one whose check
agrees holds one digest, which is taken out of its three cells, and so on until all are empty.

A table where that fails has too many differences, and is tried again as two or more of the same size, by the next
bits of its digests, with other bits for the cells. Each such round is one job over the failed tables of the round before, written to the
shared folder; digests are 64-bit and distinct, so rounds end, and nothing is given up.

Everything is SQL functions on arrays within a row. Texts are shuffled once, into slices of doc_id of about
equal size where each finds the next document; the first document of each slice is entered at the end of
the slice before it. The number of slices and their rows both grow with the root of the rows.

Defined cases: a null text is empty; empty texts have no pieces and are alike (1.0); a piece that repeats counts
once; a very long text has more tables, in time proportional to its digests and the logarithm of their number; a
text without spaces or sentence ends is one piece for each line; a null doc_id comes first in order, repeated rows
and ties follow by text; a single document is its own next; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, id_and_text, whole, written

LONG_LINE = 120
LONG_SENTENCE = 160
RADIUS = 8
TABLE_DIGESTS = 8
CELLS = 24  # of a table; a digest that comes out leaves one empty for good, so no more than this come out
ROUNDS = 16
SLICE_ROWS = 1000
DEAL_BITS = 40  # upper bits deal digests to tables, lower ones choose cells
LOW_BITS = (0, 3)  # rounds take turns, so that digests that share all cells in one do not in the next

# Where a sentence's words start a piece: words whose hash is the least around them; most fall to a neighbour, and are asked no more.
SENTENCE_PIECES = """transform(array(split(p, ' ', -1)), w -> transform(array(transform(w, x -> xxhash64(x))), h -> transform(
  array(filter(sequence(1, size(w)), i -> i = 1 OR (h[i - 1] <= ifnull(get(h, i), h[i - 1]) AND h[i - 1] <= h[i - 2]
    AND h[i - 1] = array_min(slice(h, greatest(1, i - {radius}), least(i, {radius} + 1) + {radius}))))),
  starts -> transform(starts, (at, k) -> array_join(slice(w, at, coalesce(get(starts, k + 1), size(w) + 1) - at), ' ')))[0])[0])[0]"""

DIGESTS = r"""array_distinct(transform(flatten(transform(
  flatten(transform(split({text}, '\n', -1), l -> IF(length(l) > {line}, split(l, '(?<=[.!?])\\x20', -1), array(l)))),
  p -> IF(length(p) > {sentence}, {pieces}, array(p)))), p -> xxhash64(p)))"""

# In a cell: n digests, x their exclusive or, c that of their checks. Less has that of p, without what is in q.
# Most cells have one digest or none, and are made without sums.
CELL = """CASE size(p) WHEN 0 THEN named_struct('n', 0, 'x', 0L, 'c', 0L) WHEN 1 THEN named_struct('n', 1, 'x', p[0], 'c', xxhash64(p[0]))
  ELSE named_struct('n', size(p), 'x', aggregate(p, 0L, (x, d) -> x ^ d), 'c', aggregate(p, 0L, (x, d) -> x ^ xxhash64(d))) END"""
LESS = """CASE size(p) + size(q) WHEN 0 THEN named_struct('n', 0, 'x', 0L, 'c', 0L)
  WHEN 1 THEN IF(size(p) = 1, named_struct('n', 1, 'x', p[0], 'c', xxhash64(p[0])), named_struct('n', -1, 'x', q[0], 'c', xxhash64(q[0])))
  ELSE named_struct('n', size(p) - size(q), 'x', aggregate(q, aggregate(p, 0L, (x, d) -> x ^ d), (x, d) -> x ^ d),
    'c', aggregate(q, aggregate(p, 0L, (x, d) -> x ^ xxhash64(d)), (x, d) -> x ^ xxhash64(d))) END"""
LEFT = "IF(out.n = 0 AND out.x = 0L, c, named_struct('n', c.n - out.n, 'x', c.x ^ out.x, 'c', c.c ^ out.c))"
PURE = """named_struct('a', array_distinct(transform(filter({cells}, c -> c.n = 1 AND c.c = xxhash64(c.x)), c -> c.x)),
  'b', array_distinct(transform(filter({cells}, c -> c.n = -1 AND c.c = xxhash64(c.x)), c -> c.x)))"""

# Whether nothing is in a table but the digests in `pure`, by its first row, where each digest is in one cell.
ALL_OUT = """(size(pure.a) - size(pure.b) = aggregate(slice({cells}, 1, 8), 0, (n, c) -> n + c.n)
  AND aggregate(pure.b, aggregate(pure.a, 0L, (x, d) -> x ^ d), (x, d) -> x ^ d) = aggregate(slice({cells}, 1, 8), 0L, (x, c) -> x ^ c.x)
  AND aggregate(pure.b, aggregate(pure.a, 0L, (x, d) -> x ^ xxhash64(d)), (x, d) -> x ^ xxhash64(d)) = aggregate(slice({cells}, 1, 8), 0L, (x, c) -> x ^ c.c))"""

# Digests dealt to 2^bits lists, one bit at a time, by the bits after the first `used`.
DEALT = """aggregate(IF({bits} = 0, CAST(array() AS array<bigint>), transform(sequence(1, {bits}), i -> shiftleft(1L, 64 - {used} - i))), array({digests}),
  (lists, bit) -> flatten(transform(lists, l -> array(filter(l, d -> (d & bit) = 0L), filter(l, d -> (d & bit) <> 0L)))))"""


def _placed(digests: str, low: int, bits: str = "d") -> str:
    """Who is in each of a table's 24 cells, row by row, by three ``bits`` from ``low``, ``low`` + 8 or ``low`` + 16.

    Each cell has its own filter, with numbers in it: Spark takes each small step of a lambda by itself.
    """
    each = [f"filter({digests}, d -> ({bits} & {7 << shift}L) = {cell << shift}L)" for shift in (low, low + 8, low + 16) for cell in range(8)]
    return f"array({', '.join(each)})"


def _less(a: str, b: str, low: int) -> str:
    """The table of the digests ``a``, less that of ``b``."""
    return f"zip_with({_placed(a, low)}, {_placed(b, low)}, (p, q) -> {LESS})"


def _peeled(table: str, low: int) -> str:
    """The digests of a subtracted table, those of a and those of b alone; null if some are left that do not come out.

    Most tables are done with the digests that come out first. What goes on no further holds no cells, as Spark copies it each round.
    """
    none = "CAST(array() AS array<bigint>)"
    done = f"named_struct('cells', {{cells}}, 'pure', more, 'a', {{a}}, 'b', {{b}}, 'going', {{going}})"
    a, b = "concat(s.a, s.pure.a)", "concat(s.b, s.pure.b)"
    return f"""transform(array({table}), cells -> transform(array({PURE.format(cells="cells")}), pure -> IF({ALL_OUT.format(cells="cells")}, pure,
  IF(size(pure.a) + size(pure.b) = 0, NULL, aggregate(sequence(1, {ROUNDS}),
    named_struct('cells', cells, 'pure', pure, 'a', {none}, 'b', {none}, 'going', true),
    (s, round) -> IF(NOT s.going, s, transform(array(zip_with(s.cells, {_less("s.pure.a", "s.pure.b", low)}, (c, out) -> {LEFT})),
      left -> transform(array({PURE.format(cells="left")}), more -> CASE
        WHEN size(more.a) + size(more.b) > 0 THEN {done.format(cells="left", a=a, b=b, going="true")}
        WHEN forall(left, c -> c.n = 0 AND c.x = 0L AND c.c = 0L) THEN {done.format(cells="NULL", a=a, b=b, going="false")}
        ELSE {done.format(cells="slice(left, 1, 1)", a=none, b=none, going="false")} END)[0])[0]),
    s -> IF(s.cells IS NULL, named_struct('a', s.a, 'b', s.b), NULL)))))[0])[0]"""


def paragraph_digests(text: str) -> Column:
    """Distinct digests of the pieces of the text column, in order; none for an empty text."""
    pieces = SENTENCE_PIECES.format(radius=RADIUS)
    some = F.expr(DIGESTS.format(text=f"`{text}`", line=LONG_LINE, sentence=LONG_SENTENCE, pieces=pieces))
    return F.when(F.length(text) > 0, some).otherwise(F.expr("CAST(array() AS array<bigint>)"))


def table_bits(digests: Column) -> Column:
    """k for a number of digests, the least for which 2^k tables have ``TABLE_DIGESTS`` each on average."""
    return F.ceil(F.log2(F.greatest(digests / TABLE_DIGESTS, F.lit(1.0)))).cast("int")


def cells(digests: str) -> Column:
    """The fingerprint of a column of digests: array of 24 struct<n, x, c> for each of its tables."""
    bits = f"CAST(ceil(log2(greatest(size(`{digests}`) / {TABLE_DIGESTS}, 1.0))) AS int)"
    lists = DEALT.format(bits=bits, digests=f"`{digests}`", used=0)
    return F.expr(f"flatten(transform({lists}, mine -> transform({_placed('mine', 0)}, p -> {CELL})))")


def serialized(table: str) -> Column:
    """A fingerprint as text: count, digests and checks of each cell in hexadecimal, nothing for an empty cell."""
    return F.expr(f"lower(array_join(transform(`{table}`, c -> IF(c.n = 0, '', concat_ws('.', c.n, hex(c.x), hex(c.c)))), ' '))")


def recovered(a: str, b: str, low: int = 0) -> Column:
    """For two columns of lists of digests, dealt alike: for each table, array of (x, n), n 1 where only a has x; null if too many.

    ``low`` is the first of the bits that choose cells, 0 in a fingerprint.
    """
    apart = _peeled(_less("mine", "theirs", low), low)
    signed = "concat(transform(t.a, x -> named_struct('x', x, 'n', 1)), transform(t.b, x -> named_struct('x', x, 'n', -1)))"
    tables = f"zip_with({a}, {b}, (mine, theirs) -> IF(abs(size(mine) - size(theirs)) > {CELLS}, NULL, {apart}))"
    return F.expr(f"transform({tables}, t -> IF(t IS NULL, NULL, {signed}))")


def _peel(todo: DataFrame, bits: Column, found: str, low: int = 0) -> DataFrame:
    """Each row's tables, by ``bits`` more bits of the digests: what is found as ``found``, and the digests of the tables that failed."""
    deal = todo.withColumn("bits", F.least(bits, F.lit(DEAL_BITS) - F.col("used")))
    dealt = deal.withColumns({f"{name}_lists": F.expr(DEALT.format(bits="bits", digests=name, used="used")) for name in ("a", "b")})
    tried = dealt.withColumn("tables", recovered("a_lists", "b_lists", low))
    return written(tried.select(
        "uid", "kind", F.expr(f"{found}(flatten(filter(tables, t -> t IS NOT NULL)))").alias("found"), (F.col("used") + F.col("bits")).alias("used"),
        F.expr("filter(zip_with(zip_with(a_lists, b_lists, (a, b) -> named_struct('a', a, 'b', b)), tables, (p, t) -> IF(t IS NULL, p, NULL)), "
               "p -> p IS NOT NULL)").alias("failed"),
    ), "peeled")


def differences(pairs: DataFrame, found: str = "") -> DataFrame:
    """(uid, kind, found): recovered digests by row of ``pairs`` (uid, kind, a, b), over one or more rows.

    ``a`` and ``b`` are arrays of digests, stored columns; found is an array of (x, n) with n 1 where only a has
    x, else -1, or what the SQL function named by ``found`` makes of it. The first round has as many tables as
    the smaller of the two fingerprints, the others as many as should hold the digests of a table that failed.
    """
    sizes = F.least(table_bits(F.size("a")), table_bits(F.size("b")))
    rounds = [_peel(pairs.withColumn("used", F.lit(0)), sizes, found)]
    while True:
        left = rounds[-1].select("uid", "kind", "used", F.explode("failed").alias("t")).select("uid", "kind", "used", "t.a", "t.b")
        most = left.agg(F.max("used")).first()[0]
        if most is None:
            break
        if most >= DEAL_BITS:
            raise ValueError("two digests agree in all bits that deal them to tables, which cannot happen for distinct ones in practice")
        rounds.append(_peel(left, F.greatest(F.lit(1), table_bits(F.size("a") + F.size("b"))), found, low=LOW_BITS[len(rounds) % 2]))
    out = [tried.select("uid", "kind", "found") for tried in rounds]
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]


def near(apart: Column, total: Column) -> Column:
    """Shared digests over all digests of both; 1.0 for two empty texts."""
    return F.when(total == 0, F.lit(1.0)).otherwise(1 - apart / F.greatest(total, F.lit(1)))


def likeness(pairs: DataFrame) -> DataFrame:
    """(uid, kind, near) for ``pairs`` as ``differences`` takes them."""
    found = differences(pairs, "size").groupBy("uid", "kind").agg(F.sum("found").alias("apart"))
    sizes = pairs.select("uid", "kind", (F.size("a") + F.size("b")).alias("total"))
    return found.join(sizes, ["uid", "kind"]).select("uid", "kind", near(F.col("apart"), F.col("total")).alias("near"))


def with_next(docs: DataFrame, slices: int | None = None, slice_rows: int = SLICE_ROWS, **derived: Column) -> DataFrame:
    """(doc_id, text, next_text): each document with the text of the next by doc_id, the last with the first's.

    ``derived`` columns, of the text, are worked out once for a text and come as the next document's too, as ``next_`` and the name.
    ``slices``, by default half the root of the rows, is less where a slice would have under ``slice_rows`` rows.
    """
    texts = docs.select("doc_id", whole().alias("text"))
    ids = docs.select("doc_id")
    rows = ids.count()
    n = max(1, min(slices or isqrt(rows) // 2, rows // slice_rows))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], max(10_000, 10 * n))).first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    # How many cuts are below an id, by halving steps.
    steps = ", ".join(str(1 << bit) for bit in reversed(range(max(1, len(cuts).bit_length()))))
    listed = f"CAST(split('{','.join(map(str, cuts))}', ',') AS array<bigint>)" if cuts else "CAST(array() AS array<bigint>)"
    where = F.expr(
        f"aggregate(array({steps}), 0, (at, step) -> IF(at + step <= {len(cuts)} AND get({listed}, at + step - 1) < doc_id, at + step, at))"
    )
    spread = texts.withColumn("slice", where)
    heads = ids.withColumn("slice", where).groupBy("slice").agg(F.min("doc_id").alias("head"), F.max(F.isnull("doc_id")).alias("unknown")).collect()
    heads.sort(key=lambda row: row["slice"])  # one row per slice
    before = [heads[i - 1]["slice"] for i in range(len(heads))]
    ends = texts.sparkSession.createDataFrame(
        [(None if row["unknown"] else row["head"], slice_no) for row, slice_no in zip(heads, before)], "head BIGINT, slice INT",
    )
    firsts = texts.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", "slice")
    entered = spread.withColumn("end", F.lit(False)).unionByName(firsts.withColumn("end", F.lit(True))).withColumns(derived)
    order = Window.partitionBy("slice").orderBy("end", "doc_id", "text")
    following = {f"next_{name}": F.lead(name).over(order) for name in ("text", *derived)}
    return entered.withColumns(following).where(~F.col("end")).select("doc_id", "text", *derived, *following)


def op8_paragraph_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_next(id_and_text(documents(spark, sf_dir)), own=paragraph_digests("text"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    read = written(pairs.withColumn("edited_text", edited).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        "own", paragraph_digests("edited_text").alias("edited"), F.col("next_own").alias("next"),
    ), "digests")
    kinds = ("edited", "next")
    both = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("b")) for kind in kinds)))
    compared = read.select("uid", F.col("own").alias("a"), both.alias("other")).select("uid", "other.kind", "a", "other.b")
    apart = differences(compared, "size").groupBy("uid").agg(
        *(F.sum(F.when(F.col("kind") == kind, F.col("found"))).alias(f"apart_{kind}") for kind in kinds),
    )
    # Fingerprints are written out at the end: their digests are shorter to shuffle.
    totals = {f"total_{kind}": F.size("own") + F.size(kind) for kind in kinds}
    rows = read.withColumns(totals).drop("next").join(apart, "uid").withColumns({f"{name}_cells": cells(name) for name in ("own", "edited")})
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", serialized("own_cells").alias("fingerprint"),
        serialized("edited_cells").alias("edited_fingerprint"),
        *(near(F.col(f"apart_{kind}"), F.col(f"total_{kind}")).alias(f"near_{kind}") for kind in kinds),
    )
