"""Order MinHash: fingerprints that follow the edit distance of texts. DataFrame functions only.

A k-mer (k code points on end) and its occurrence number, counted from the start of the text, make an
element; repeats are elements of their own. One hash of an element deals it to one of ``SKETCHES`` sketches
and ranks it there (one permutation for all sketches). Each sketch selects its ``TUPLE`` least elements,
puts them back in text order and hashes the tuple, so a sketch of two texts is equal if they share
the selected elements in the same order. The likeness is the share of equal sketches among those that
either text has.

All work on a text is on arrays of longs, an element's hash in the upper and its place in the lower
bits, so that sorting by hash and by place are plain sorts. Time and memory are in proportion to the
text's length (sorting apart).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wayfare.session import settle

K, TUPLE, SKETCHES = 8, 2, 64
PLACE_BITS = 30  # byte places in UTF-32, so texts of up to 2^28 code points
PLACES = (1 << PLACE_BITS) - 1
LONG = 1500  # elements from which on halving is faster than a scan
RANGES = 4096  # of the order of ids, at most

_long = lambda n: F.lit(n).cast("bigint")


def _with(value: Column, body) -> Column:
    """``body`` of a value that is worked out once (a column read inside a lambda is copied each time)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _packed(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(_long(~PLACES)).bitwiseOR(place)


def _kmers(text: Column, k: int) -> Column:
    """The hash and place of each k-mer; a shorter text is one, an empty one has none."""
    def each(raw: Column) -> Column:  # UTF-32: four bytes for each code point, cut without counting
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.octet_length(raw) - 4 * k, F.lit(0)) + 1, F.lit(4)),
            lambda at: _packed(F.xxhash64(F.substring(raw, at, F.lit(4 * k))), at.cast("bigint")))

    return F.when(text == "", F.array_repeat(_long(0), 0)).otherwise(_with(F.encode(text, "UTF-32"), each))


def _behind(own: Column, by: int) -> Column:
    """What stands ``by`` places before each element; the first ones get something unlike themselves."""
    return F.concat(F.transform(F.slice(own, 1, by), F.bitwise_not), own)


def _unlike(one: Column, other: Column, shift: int) -> Column:
    return F.shiftright(one.bitwiseXOR(other), shift) != 0


def _numbered(firsts: str, repeats: str) -> Column:
    """The first ones of equal k-mers, and the others (both sorted) with their occurrence number in the hash,
    which is their place among the others of their k-mer, from 1."""
    key = lambda x: F.shiftright(x, PLACE_BITS)

    def each(own: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(own) - 1),
                          lambda i: (i == 0) | (key(F.get(own, i)) != key(F.get(own, i - 1))))
        counted = F.flatten(_with(F.concat(begins, F.array(F.size(own))), lambda edges: F.transform(
            F.sequence(F.lit(1), F.size(edges) - 1), lambda j: F.sequence(F.lit(1), edges[j] - edges[j - 1]))))
        return _with(counted, lambda n: F.transform(own, lambda x, i: _packed(
            F.xxhash64(key(x), F.get(n, i)), x.bitwiseAND(_long(PLACES)))))

    more = F.when(F.size(repeats) == 0, F.col(repeats)).otherwise(_with(F.col(repeats), each))
    return F.concat(F.col(firsts), more)


def _least(sorted_: Column, size: int, sketches: int) -> Column:
    """The first ``size`` elements of each sketch. In a long array a sketch's first one is found by halving."""
    shift = 64 - (sketches.bit_length() - 1)
    powers = F.array(*(F.lit(1 << b) for b in reversed(range(PLACE_BITS - 2))))

    def scanned(all_: Column) -> Column:
        return _with(_behind(all_, size), lambda behind: F.filter(
            all_, lambda x, i: _unlike(F.get(behind, i), x, shift)))

    def halved(all_: Column, steps: Column) -> Column:
        def of_sketch(number: Column) -> Column:
            least = F.shiftleft(number, shift)
            first = F.aggregate(steps, F.lit(0), lambda n, p: F.when(
                (n + p <= F.size(all_)) & (F.get(all_, n + p - 1) < least), n + p).otherwise(n))
            return F.filter(F.slice(all_, first + 1, size), lambda x: F.shiftright(x, shift) == number)

        return F.flatten(F.transform(_sketch_numbers(sketches), of_sketch))

    return _with(sorted_, lambda all_: F.when(F.size(all_) < LONG, scanned(all_)).otherwise(_with(
        F.filter(powers, lambda p: p <= F.size(all_)), lambda steps: halved(all_, steps))))


def _sketch_numbers(sketches: int) -> Column:
    return F.sequence(_long(-sketches // 2), _long(sketches // 2 - 1))


def _tuples(chosen: Column, size: int, sketches: int) -> Column:
    """A number from 1 to 65535 for each sketch, from the elements chosen for it; 0 if it has none."""
    shift = 64 - (sketches.bit_length() - 1)
    of = lambda x: F.shiftright(x, shift)

    def hashed(own: Column) -> Column:
        by_place = F.sort_array(F.transform(own, lambda x: F.shiftleft(x.bitwiseAND(_long(PLACES)), 64 - PLACE_BITS)
                                            .bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))))
        words = F.transform(by_place, lambda x: x.bitwiseAND(_long((1 << 64 - PLACE_BITS) - 1)))
        return (F.pmod(F.xxhash64(words), _long(65535)) + 1).cast("int")

    def complete(chosen: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(sketches - 1)),
                           lambda s: hashed(F.slice(chosen, s * size + 1, size)))

    def partial(chosen: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(chosen) - 1),
                          lambda i: (i == 0) | (of(F.get(chosen, i)) != of(F.get(chosen, i - 1))))
        entries = F.transform(firsts, lambda i: F.struct(of(F.get(chosen, i)), hashed(F.filter(
            F.slice(chosen, i + 1, size), lambda x: of(x) == of(F.get(chosen, i))))))
        return _with(F.map_from_entries(entries), lambda told: F.transform(
            _sketch_numbers(sketches), lambda s: F.coalesce(told[s], F.lit(0))))

    return (F.when(F.size(chosen) == 0, F.array_repeat(F.lit(0), sketches))
            .when(F.size(chosen) == size * sketches, _with(chosen, complete)).otherwise(_with(chosen, partial)))


def with_sketches(rows: DataFrame, text: str, name: str, k: int = K, size: int = TUPLE,
                  sketches: int = SKETCHES) -> DataFrame:
    """The rows with the text's sketches as a further column, an array of ``sketches`` (a power of two) numbers.

    Null counts as empty; an empty text has 0 in all sketches.
    """
    if sketches & sketches - 1 or not 2 <= sketches <= 1 << 16:
        raise ValueError("the number of sketches is a power of two")
    helper = _unused(rows, name)
    firsts, repeats = f"{helper}firsts", f"{helper}repeats"
    own = F.col(helper)
    # each step sorts longs outside of the lambdas, where that is compiled
    rows = rows.withColumn(helper, _kmers(F.coalesce(F.col(text), F.lit("")), k))
    rows = rows.withColumn(helper, F.sort_array(own))
    # of equal k-mers the first stays as it is, the others are rare and numbered; elements are all different
    rows = rows.withColumn(firsts, _with(own, lambda all_: _with(_behind(all_, 1), lambda behind: F.filter(
        all_, lambda x, i: _unlike(F.get(behind, i), x, PLACE_BITS)))))
    rows = rows.withColumn(repeats, F.array_except(own, F.col(firsts)))
    rows = rows.withColumn(helper, _numbered(firsts, repeats)).drop(firsts, repeats)
    rows = rows.withColumn(helper, F.sort_array(own))
    rows = rows.withColumn(helper, _least(own, size, sketches))
    return rows.withColumn(name, _tuples(own, size, sketches)).drop(helper)


def _unused(rows: DataFrame, *names: str) -> str:
    mark = "_"
    while any(n.startswith(mark) for n in [*rows.columns, *names]):
        mark += "_"
    return mark


def likeness(one: str, other: str) -> Column:
    """The share of equal sketches, of those that either has; 1 if neither has any."""
    both = F.arrays_zip(F.col(one).alias("a"), F.col(other).alias("b"))
    used = F.size(F.filter(both, lambda x: (x["a"] != 0) | (x["b"] != 0)))
    equal = F.size(F.filter(both, lambda x: (x["a"] != 0) & (x["a"] == x["b"])))
    return F.when(used == 0, F.lit(1.0)).otherwise(equal / used)


def written(sketches: str) -> Column:
    """Four hex digits for each sketch."""
    return F.lower(F.array_join(F.transform(sketches, lambda x: F.lpad(F.hex(x), 4, "0")), ""))


# ---- a table's rows and the next ones

def _spread(line: Column) -> Column:
    """A row's place in [0, 1) among rows of its id."""
    return F.shiftrightunsigned(line, 11).cast("double") / F.lit(float(1 << 53))


def _range_of(bounds: list, key: Column, line: Column, kind) -> Column:
    """The number of the range between sorted bounds that a key is in. A key that is the bound of several
    ranges is spread over them by its line, nulls come first, spread over as many."""
    edges = F.array(*map(F.lit, bounds)).cast(ArrayType(kind))
    below = F.size(F.filter(edges, lambda b: b < key))
    upto = F.size(F.filter(edges, lambda b: b <= key))
    share = F.floor(_spread(line) * (upto - below + 1)).cast("int")
    nulls = F.floor(_spread(line) * F.lit(len(bounds) + 1)).cast("int") - len(bounds) - 1
    return F.when(key.isNull(), nulls).otherwise(F.when(upto == below, below).otherwise(below + share))


def in_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """Rows (``doc_id``, ``text``) with ``line``, by which those of one id are ordered, and ``part``, the number of
    their range; ``last`` marks one row more at the end of each range, a copy of the first of the next
    range that has any (of the very first range at the end). Ranges end at quantiles of the ids."""
    kind = rows.schema["doc_id"].dataType
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = rows.select(F.approx_percentile("doc_id", cuts, 10 * ranges).alias("b")).first()["b"] if cuts else []
    rows = rows.withColumn("line", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("part", _range_of(bounds or [], F.col("doc_id"), F.col("line"), kind))
    first = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", F.shiftrightunsigned("line", 11), "line"))
    firsts = settle(rows.groupBy("part").agg(first.alias("first")), "first-rows")  # one row for each range
    in_order = Window.orderBy("part")
    before = F.coalesce(F.lag("part").over(in_order), F.max("part").over(in_order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = firsts.select(F.col("first.doc_id").alias("first_id"), F.col("first.line").alias("first_line"),
                          F.col("part").alias("first_part"), before.alias("before"))
    met = (rows["part"] == edges["first_part"]) & rows["doc_id"].eqNullSafe(edges["first_id"]) & (
        rows["line"] == edges["first_line"])
    copies = rows.join(edges, met).select("doc_id", "text", "line", F.col("before").alias("part"))
    copies = copies.dropDuplicates(["part"]).withColumn("last", F.lit(True))
    return rows.withColumn("last", F.lit(False)).unionByName(copies)


def fingerprints(docs: DataFrame, k: int = K, size: int = TUPLE, sketches: int = SKETCHES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``sketches`` (an array) of each row. Null texts count as empty; other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_sketches(rows, "text", "sketches", k, size, sketches).drop("text")


def edit_likeness(docs: DataFrame, ranges: int | None = None, k: int = K, size: int = TUPLE,
                  sketches: int = SKETCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next`` of each
    row: a text against its edited form and against the next row's text.

    The edited form has the last quarter (rounded down) of the code points replaced by the first as many of the
    next text, or all if that has fewer. The next row is that of the next ``doc_id`` (numbers, dates or times;
    nulls first; rows of one id follow each other by a hash of the text), after the last row the first; a
    single row follows itself. Null texts count as empty, repeated rows are rows of their own, an empty table
    gives no rows, other columns are ignored. Texts are shuffled once, by range.
    """
    spark = docs.sparkSession
    ranges = ranges or min(RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_sketches(in_ranges(rows, ranges), "text", "own", k, size, sketches)
    order = Window.partitionBy("part").orderBy(
        "last", F.asc_nulls_first("doc_id"), F.shiftrightunsigned("line", 11), "line")
    rows = rows.withColumn("next", F.lead(F.struct("text", "own")).over(order)).where(~F.col("last"))
    count = F.char_length("text")
    quarter = F.floor(count / 4).cast("int")
    rows = rows.select(
        "doc_id", "own", F.col("next.own").alias("follows"), count.cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), count - quarter),
                 F.substring("next.text", F.lit(1), quarter)).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_sketches(rows, "edited", "changed", k, size, sketches)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", written("own").alias("fingerprint"),
        written("changed").alias("edited_fingerprint"), likeness("own", "changed").alias("near_edited"),
        likeness("own", "follows").alias("near_next"))
