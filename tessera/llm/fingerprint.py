"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in SQL functions only.

Each paragraph (line) of a text is cut into pieces of up to 32 words; the first one begins with pieces of up to 4, 8
and 16 words, so that short texts have several pieces and long ones few. A piece's digest is
44 bits of its hash with a 20-bit checksum below them. A sketch is three rows of 16 cells; each digest is
XORed into one cell of each row. Subtracting two sketches is XOR: digests that both texts have cancel.

Peeling: cells whose checksum fits hold one digest each; they are taken out of their three cells, and so on until all cells
are empty. The digests recovered are the symmetric difference of the two sets.

A fingerprint is text: the number of pieces and the first sketch, and, where that one cannot be emptied by itself, a larger
sketch: a power of two of tables of the same shape, to which the digests are dealt by another hash. A
table that cannot be emptied is made again with other hashes, and after SALTS attempts it is the digests themselves. So
every fingerprint can be inverted, and two of them are all a comparison needs: it subtracts the first sketches, and if
cells remain it inverts both fingerprints and compares the sets.

The likeness of two fingerprints is 1 - difference / (pieces of one + pieces of the other).

Defined results: a null text is an empty one, with an all-zero sketch; two texts without pieces have
likeness 1; repeated pieces of a text count once; rows with equal ids follow each other in the order of a hash
of their texts; a row without an id comes before all others; a single row is its own next one; an
empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import partitions

ROW, CELLS = 16, 48
CHECK, KEY = (1 << 20) - 1, (1 << 44) - 1
#: A single sketch with more digests is not tried. Digests for each table of a larger sketch, at most; attempts for each table.
MOST, LOAD, SALTS = 40, 16, 4


def _pieces(text: str) -> str:
    """Distinct digests of the pieces of an SQL text column."""
    start = "if(n > 0, 32 * i + 1, case i when 0 then 1 when 1 then 5 when 2 then 13 else 32 * i - 67 end)"
    size = "if(n > 0, 32, case i when 0 then 4 when 1 then 8 when 2 then 16 else 32 end)"
    last = "if(n > 0, greatest(0, cast(ceil(size(ws) / 32) as int) - 1), 2 + greatest(0, cast(ceil((size(ws) - 28) / 32) as int)))"
    of_line = f"transform(sequence(0, {last}), i -> array_join(slice(ws, {start}, {size}), ' '))"
    lines = rf"flatten(transform(split({text}, '\n'), (l, n) -> transform(array(filter(split(l, '\\s+'), w -> w <> '')), ws -> filter({of_line}, p -> p <> ''))[0]))"
    return f"array_distinct(transform({lines}, p -> transform(array(xxhash64(p) & {KEY}L), k -> shiftleft(k, 20) | (xxhash64(k) & {CHECK}L))[0]))"


def _bind(value: str, name: str, body: str) -> str:
    """body with name bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _entries(digests: str, salt: str) -> str:
    """Digests with their cells, one in each row, as bits of a mask."""
    cells = " | ".join(f"shiftleft(1L, cast({ROW * r} + (shiftrightunsigned(h, {12 * r}) & {ROW - 1}) as int))" for r in range(CELLS // ROW))
    made = _bind(f"xxhash64(x, {salt})", "h", f"named_struct('x', x, 'm', {cells})")
    return f"transform({digests}, x -> {made})"


def _folded(table: str, entries: str) -> str:
    """A table with entries XORed into their cells, which puts them in or takes them out."""
    return _bind(entries, "es", f"transform({table}, (c, i) -> aggregate(es, c, (y, e) -> if(getbit(e.m, i) = 1, y ^ e.x, y)))")


def _table(digests: str, salt: str) -> str:
    return _folded(f"array_repeat(0L, {CELLS})", _entries(digests, salt))


def _peel(table: str, salt: str) -> str:
    """The digests of a table, or null if cells remain. Each round takes out all digests that stand alone in a cell."""
    pure = f"array_distinct(filter(s.t, c -> c <> 0 and (c & {CHECK}L) = (xxhash64(shiftrightunsigned(c, 20)) & {CHECK}L)))"
    step = _bind(pure, "ps", f"if(size(ps) = 0, named_struct('t', s.t, 'd', s.d, 'done', true), named_struct('t', {_folded('s.t', _entries('ps', salt))}, 'd', concat(s.d, ps), 'done', false))")
    start = f"named_struct('t', {table}, 'd', cast(array() as array<bigint>), 'done', false)"
    return f"aggregate(sequence(0, {CELLS}), {start}, (s, n) -> if(s.done, s, {step}), s -> if(exists(s.t, c -> c <> 0), cast(null as array<bigint>), s.d))"


def _hex(values: str) -> str:
    return f"array_join(transform({values}, c -> lpad(lower(hex(c)), 16, '0')), '')"


def _longs(text: str) -> str:
    """What _hex() wrote."""
    return f"transform(regexp_extract_all({text}, '.{{16}}', 0), k -> cast(conv(k, 16, -10) as bigint))"


def _one_table(digests: str) -> str:
    """A table of a larger sketch as text: the first attempt's number and cells that give back all digests, or = and the digests."""
    made = _bind(_table(digests, "salt"), "tb", _bind(_peel("tb", "salt"), "got", f"if(size(got) = size({digests}), concat(salt, {_hex('tb')}), cast(null as string))"))
    tried = f"aggregate(sequence(1, {SALTS}), cast(null as string), (found, salt) -> if(found is not null or size({digests}) > {MOST}, found, {made}))"
    return f"coalesce({tried}, concat('=', {_hex(f'array_sort({digests})')}))"


def _larger(digests: str) -> str:
    """The tables of a larger sketch. Digests are dealt to them in two steps, so that the work is not their number times the tables'."""
    dealt = f"transform({digests}, x -> named_struct('x', x, 'g', xxhash64(x, 0, 0)))"
    bits = f"cast(greatest(0, ceil(log2(size({digests}) / {LOAD}))) as int)"
    coarse = "transform(sequence(0, shiftleft(1, b div 2) - 1), u -> filter(gs, e -> (e.g & (shiftleft(1, b div 2) - 1)) = u))"
    fine = "transform(sequence(0, shiftleft(1, b - b div 2) - 1), v -> transform(filter(part, e -> (shiftrightunsigned(e.g, 32) & (shiftleft(1, b - b div 2) - 1)) = v), e -> e.x))"
    tables = _bind(dealt, "gs", _bind(bits, "b", f"flatten(transform({coarse}, part -> {fine}))"))
    return f"array_join(transform({tables}, own -> concat(':', {_one_table('own')})), '')"


def _fingerprint(digests: str) -> str:
    """An array of distinct digests as a fingerprint."""
    alone = f"coalesce(size({_peel('t0', '0')}) = size({digests}), false)"
    rest = f"if(if(size({digests}) > {MOST}, false, {alone}), '', {_larger(digests)})"
    return _bind(_table(digests, "0"), "t0", f"concat(size({digests}), ':', {_hex('t0')}, {rest})")


def _digests_of(parts: str, first: str) -> str:
    """All digests of a fingerprint's parts (count, first sketch, tables); first: the first sketch's cells."""
    table = f"if(substr(tx, 1, 1) = '=', {_longs('substr(tx, 2)')}, {_bind('cast(substr(tx, 1, 1) as int)', 'salt', _peel(_longs('substr(tx, 2)'), 'salt'))})"
    return f"if(size({parts}) = 2, {_peel(first, '0')}, flatten(transform(slice({parts}, 3, size({parts}) - 2), tx -> {table})))"


def _likenesses(a: str, others: str) -> str:
    """The likeness of a fingerprint to each of an array of others. Sketches are read once."""
    counts = "cast(pa[0] as int) + cast(pb[0] as int)"
    minus = "zip_with(ca, cb, (x, y) -> x ^ y)"
    near = f"if(abs(cast(pa[0] as int) - cast(pb[0] as int)) > {MOST}, cast(null as int), size({_peel(minus, '0')}))"
    exact = _bind(_digests_of("pa", "ca"), "da", _bind(_digests_of("pb", "cb"), "db", "size(array_except(da, db)) + size(array_except(db, da))"))
    value = f"if({counts} = 0, 1.0D, 1.0D - coalesce({near}, {exact}) / cast({counts} as double))"
    each = _bind("split(f, ':')", "pb", _bind(_longs("pb[1]"), "cb", value))
    return _bind(f"split({a}, ':')", "pa", _bind(_longs("pa[1]"), "ca", f"transform({others}, f -> {each})"))


def fingerprint_of(text: str) -> Column:
    """The fingerprint of a text column."""
    return F.expr(_bind(_pieces(f"coalesce({text}, '')"), "ds", _fingerprint("ds")))


def likeness(a: str, b: str) -> Column:
    """The likeness of two columns of fingerprints."""
    return F.expr(f"{_likenesses(a, f'array({b})')}[0]")


def _index(starts: list[int], key):
    """The number of the last start that is not above key, by a coarse and a fine look-up."""
    wide = max(1, round(len(starts) ** 0.5))
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    at = (F.size(F.filter(array(starts[::wide]), lambda c: c <= key)) - 1) * wide
    return (at + F.size(F.filter(F.slice(array(starts), at + 1, F.lit(wide)), lambda c: c <= key)) - 1).cast("int")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, fingerprint, and those of the next row in ascending id (next_text, next_fingerprint), the first after the last.

    Ids are cut into ranges at their quantiles. A range's first row is also entered at the end of the range
    before it, so no range needs to see another, and the last one ends with the first row of all.
    """
    least = -(1 << 63)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(least).cast("long"))
    wanted = 4 * partitions(docs.sparkSession)
    ids = base.select(key.alias("k"))
    cuts = ids.approxQuantile("k", [k / wanted for k in range(1, wanted)], 0.25 / wanted) or []
    ranges = sorted({least} | {max(least, min(int(c), -least - 1)) for c in cuts})
    # as many rows as there are ranges: the first id of each that has any
    starts = sorted(r["k"] for r in ids.groupBy(_index(ranges, F.col("k")).alias("b")).agg(F.min("k").alias("k")).collect()) or [least]
    n = len(starts)
    at = _index(starts, key)
    own = F.struct(at.alias("b"), F.lit(0).alias("copy"))
    begins = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), at + 1) == key
    entries = F.when(begins, F.array(own, F.struct(F.pmod(at - 1, F.lit(n)).cast("int").alias("b"), F.lit(1).alias("copy")))).otherwise(F.array(own))
    placed = base.withColumn("fingerprint", fingerprint_of("text")).withColumn("e", F.explode(entries))
    order = Window.partitionBy("e.b").orderBy("e.copy", "doc_id", F.xxhash64("text"))
    following = placed.withColumns({"next_text": F.lead("text").over(order), "next_fingerprint": F.lead("fingerprint").over(order)})
    return following.where("e.copy = 0").drop("e")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = with_next(docs, id_col, text_col)
    tail = F.floor(F.length("text") / 4).cast("int")
    edited = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.substring("next_text", F.lit(1), tail)))
    whole = edited.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint_of("edited").alias("edited_fingerprint"), "next_fingerprint")
    # one expression for both comparisons: what a task compiles stays small
    compared = whole.withColumn("near", F.expr(_likenesses("fingerprint", "array(edited_fingerprint, next_fingerprint)")))
    return compared.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.expr("near[0]").alias("near_edited"), F.expr("near[1]").alias("near_next"))
