"""Document fingerprints by winnowing, in DataFrame operations only.

Words give rolling k-gram hashes; of every ``window`` consecutive hashes the
smallest is chosen, the rightmost among equals, and its position is kept. Two
texts that share ``k + window - 1`` consecutive words share a fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Low bits of a fingerprint hold the position, counted down, so that the smaller
#: of two equal hashes' entries is the one further right.
POSITION_BITS = 24

#: Rows that share one place in the order by id; places hold neighbouring ids.
ROWS_PER_PLACE = 1_000
MOST_PLACES = 10_000


def bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), f)[0]


def word_list(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    spaces = "\x20\x09\x0a\x0b\x0c\x0d"
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(spaces))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[\\x20\\x09-\\x0D]+"))


def _gram_hashes(tokens: Column, k: int, pack) -> Column:
    """``pack(hash, place)`` for the window of ``k`` words that rolls over ``tokens``.

    Fewer than ``k`` words make one gram; no words none.
    """
    return bound(tokens, lambda words: F.when(
        F.size(words) >= k, F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - (k - 1), F.lit(0))),
            lambda w, i: pack(F.xxhash64(w, *(F.get(words, i + j) for j in range(1, k))), i))
    ).when(F.size(words) > 0, F.array(pack(F.xxhash64(words), F.lit(0)))).otherwise(
        F.array().cast("array<bigint>")))


def winnow(text: Column, k: int = 5, window: int = 9) -> Column:
    """Fingerprints of ``text`` as longs: a hash, then the position counted down.

    A text of fewer than ``k`` words has one gram, of fewer than ``k + window - 1``
    one window; an empty or null text has no fingerprint.
    """
    top = (1 << POSITION_BITS) - 1
    high = F.lit((1 << 63) - (1 << POSITION_BITS))
    packed = _gram_hashes(
        word_list(text), k, lambda h, i: h.bitwiseAND(high).bitwiseOR((F.lit(top) - i % (top + 1)).cast("bigint")))

    def smallest(values: Column, have: int) -> Column:
        """The smallest of each ``window`` values from those of each ``have``."""
        if have == window:
            return values
        near, far = min(have, window - have), min(2 * have, window - have)
        shifts = sorted({near, far})
        return smallest(bound(values, lambda v: F.transform(
            F.slice(v, 1, F.greatest(F.size(v) - shifts[-1], F.lit(0))),
            lambda x, i: F.least(x, *(F.get(v, i + s) for s in shifts)))), have + shifts[-1])

    def chosen(values: Column) -> Column:
        return F.when(F.size(values) >= window, smallest(values, 1)).when(
            F.size(values) > 0, F.array(F.array_min(values))).otherwise(values)

    return bound(bound(packed, chosen), lambda m: F.filter(m, lambda x, i: ~x.eqNullSafe(F.get(m, i - 1))))


def positions(prints: Column) -> Column:
    """The k-gram positions of fingerprints, in order of the text."""
    top = (1 << POSITION_BITS) - 1
    return F.transform(prints, lambda x: (F.lit(top) - x.bitwiseAND(F.lit(top))).cast("int"))


def hashes(prints: Column) -> Column:
    return F.transform(prints, lambda x: F.shiftright(x, POSITION_BITS))


def shown(prints: Column) -> Column:
    """``hash@position`` of every fingerprint, in order, joined by spaces."""
    top = (1 << POSITION_BITS) - 1
    return F.array_join(F.transform(prints, lambda x: F.concat_ws(
        "@", F.hex(F.shiftright(x, POSITION_BITS)), F.lit(top) - x.bitwiseAND(F.lit(top)))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two texts' distinct fingerprint hashes; two without any are alike."""
    return bound(F.struct(F.array_distinct(hashes(a)).alias("a"), F.array_distinct(hashes(b)).alias("b")), lambda s: bound(
        F.size(F.array_intersect(s["a"], s["b"])),
        lambda both: F.when(F.size(s["a"]) + F.size(s["b"]) == 0, F.lit(1.0)).otherwise(
            both / (F.size(s["a"]) + F.size(s["b"]) - both)),
    ))


def _places(docs: DataFrame, id_col: str) -> Column:
    """A number per row that falls with the id, about ROWS_PER_PLACE rows each.

    Bounds are quantiles of the ids over all rows (two aggregates, at most
    MOST_PLACES numbers on the driver). Null ids come after all others.
    """
    n = docs.count()
    parts = max(1, min(MOST_PLACES, n // ROWS_PER_PLACE))
    shares = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(id_col, shares or [0.5], 10 * parts)).first()[0] or []
    bounds = sorted(set(bounds)) if shares else []
    # searched by halves, so the expression stays as deep as the logarithm of the bounds
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(-lo)
        mid = (lo + hi) // 2
        return F.when(F.col(id_col) < bounds[mid], search(lo, mid)).otherwise(search(mid + 1, hi))

    if len(bounds) <= 200:
        place = search(0, len(bounds))
    else:
        literal = F.array(*map(F.lit, bounds))
        place = -F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), F.struct(
            F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), lambda s, _: bound(
                F.floor((s["lo"] + s["hi"]) / 2).cast("int"), lambda mid: F.when(s["lo"] >= s["hi"], s).when(
                    F.col(id_col) < F.get(literal, mid), F.struct(s["lo"].alias("lo"), mid.alias("hi"))
                ).otherwise(F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))), lambda s: s["lo"])
    return F.when(F.col(id_col).isNull(), F.lit(1)).otherwise(place)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = 5, window: int = 9) -> DataFrame:
    """Fingerprints of every text, of its edited text and its likeness to the next.

    The next document is that of the next smaller id (then text), after the last
    one the first; nulls come last among ids, and a null text is empty. The
    edited text has its last floor(n/2) characters replaced by the first as many
    of the next document. A single row is its own next. Repeated rows all stay;
    columns other than the two named are not read.

    The order is taken within places of neighbouring ids; only the first row of
    each place is passed on to the place before it, so no task sees all rows.
    """
    own = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    own = own.withColumn("_place", _places(docs.select(id_col), id_col))
    own = own.withColumn("_prints", F.explode(F.array(winnow(F.col("_text"), k, window))))
    order = [F.col(id_col).desc_nulls_last(), F.col("_text").desc()]
    within = Window.partitionBy("_place").orderBy(*order)
    row = F.struct("_text", "_prints")
    placed = own.withColumn("_next", F.lead(row).over(within))

    # the first row of each place, read by the place before it or the last one;
    # the largest ids are broadcast: one per place, MOST_PLACES + 1 at most
    place = _places(docs.select(id_col), id_col)
    largest = docs.select(id_col).withColumn("_place", place).groupBy("_place").agg(F.max(id_col).alias("_largest"))
    firsts = docs.join(F.broadcast(largest), F.col(id_col).eqNullSafe(F.col("_largest")), "inner")
    firsts = firsts.groupBy("_place").agg(F.max(F.coalesce(F.col(text_col), F.lit(""))).alias("_first"))
    ring = Window.orderBy("_place")
    firsts = firsts.select("_place", F.coalesce(
        F.lead("_first").over(ring), F.first("_first").over(ring)).alias("_after"))
    both = placed.join(firsts, "_place", "left")
    follower = F.coalesce(F.col("_next._text"), F.col("_after"))
    follower_prints = F.when(F.col("_next").isNotNull(), F.col("_next._prints")).otherwise(
        winnow(F.col("_after"), k, window))
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(follower, F.lit(1), half))
    out = both.select(
        id_col, n.cast("bigint").alias("n_chars"), F.col("_prints"),
        F.explode(F.array(F.struct(edited.alias("text"), follower_prints.alias("next")))).alias("_e"),
    )
    out = out.select(
        id_col, "n_chars", "_prints", F.sha2(F.col("_e.text"), 256).alias("edited_sha256"), F.col("_e.next").alias("_next"),
        F.explode(F.array(winnow(F.col("_e.text"), k, window))).alias("_edited"),
    )
    return out.select(
        id_col, "n_chars", "edited_sha256", shown(F.col("_prints")).alias("fingerprint"),
        shown(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_prints"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_prints"), F.col("_next")).alias("near_next"),
    )
