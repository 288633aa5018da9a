"""Line dedup by an exact set-similarity join, in DataFrame functions alone.

A line with a word is removed if an earlier line (by doc_id, then place in the text) is equal to it or has a
word set of Jaccard similarity `percent` or more. Equal lines meet in an aggregate; the rest is one join:
1. Each distinct line orders its words by rarity and is posted under the prefix that two similar lines cannot
   both miss. Rarity is the logarithm of a word's count over all lines, in fixed buckets of word hashes; hashes
   break ties. Any order that all lines share is exact; a finer one makes shorter lists.
2. A semi-join of the postings with themselves keeps those that have a partner which length, positional and
   parity filter (128 bits a line that differ in no more places than the word sets do) let pass. It stops at a
   posting's first partner, so its rows are linear however large a group of copies is.
3. What is left meets in stars: each line meets the first line of its lists, and of random parts of them. Pairs
   are verified on their words; only lines that no star settles meet all earlier lines of their lists, behind a
   parity filter of 256 other bits.
A line of so few words that only an equal word set is similar (three at 80 percent) is posted once, under all
its words. The filters compare words by 64-bit hashes, verification compares the words.
Defined results: null text has no lines and stays null; lines without words stay; rows alike in doc_id and text
count as one document and come out alike; rows without doc_id come last; an empty table gives no rows; all other
columns are carried through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import discard, files_for, saved, setting

PERCENT = 80
#: Buckets of word hashes whose counts give the rarity. With few of them rare words share theirs with common ones, and lists grow.
BUCKETS = 1 << 18
#: Lines of more words than this have a second long in the parity filter of all postings.
LONG = 64
#: Into how many random parts each list falls, one star round after the other.
PARTS = (1, 16, 256)
#: Ids of lines that may be broadcast (8 bytes each).
BROADCAST_IDS = 1 << 20
#: What parts words in a line besides spaces.
WHITE = "\t\x0b\f\r"
#: The longs of the parity filter of all postings, and of the one of lines that pass it: 64 bits each.
BITS, WIDE = ("b0", "b1"), tuple(f"w{k}" for k in range(4))


def has_word(line: Column) -> Column:
    """Whether anything but white space stands in a line; the first character mostly tells."""
    return ~F.ascii(F.ltrim(line)).isin(0, 9, 11, 12, 13) | line.rlike(r"[^ \t\x0B\f\r]")


def spaced(text: Column) -> Column:
    """text with spaces for all that parts words in a line. Lines that only differ in this have one set of words."""
    odd = reduce(Column.__or__, (F.contains(text, F.lit(x)) for x in WHITE))
    return F.when(odd, F.translate(text, WHITE, " " * len(WHITE))).otherwise(text)


def words_of(line: Column) -> Column:
    """The distinct words of a line of spaced text."""
    return F.array_remove(F.array_distinct(F.split(line, " ")), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rk"))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def rarity(docs: DataFrame) -> Column:
    """The rarity of each bucket of word hashes: four steps a doubling of the count of its words. Numbers up to 127 are shared
    objects in the JVM, so that looking one up touches little memory."""
    words = docs.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    counts = words.groupBy(_bucket(F.xxhash64("word")).alias("bucket")).agg(F.count("*").alias("n"))
    # The first table of a compiled aggregate holds 2^16 groups by default; what is beyond goes through a slower one.
    with setting(docs.sparkSession, "spark.sql.codegen.aggregate.fastHashMap.capacityBit", str(BUCKETS.bit_length())):
        found = counts.select("bucket", F.round(4 * F.log2("n")).cast("int").alias("level")).toArrow()
    level = dict(zip(found["bucket"].to_pylist(), found["level"].to_pylist()))
    return F.split(F.lit(",".join(str(min(127, level.get(b, 0))) for b in range(BUCKETS))), ",").cast("array<bigint>")


def _bits(h: Column, planes: int) -> list[Column]:
    """A token's bit in each plane, of 64 classes: of all tokens, those with one flag of their hash, with another, and with
    both (2 or 4 planes). Told apart by their flags the tokens have 64 classes a plane."""
    flag = lambda k: F.shiftright(h, 6 + k).bitwiseAND(F.lit(1))
    marks = (F.lit(1).cast("bigint"), flag(0), flag(1), flag(0).bitwiseAND(flag(1)))
    return [F.call_function("shiftleft", mark, h.bitwiseAND(F.lit(63)).cast("int")) for mark in marks[:planes]]


def _parity(tokens: Column, planes: int) -> list[Column]:
    """The parity of a line's tokens in the classes of _bits."""
    none = F.lit(0).cast("bigint")
    over = lambda k: F.aggregate(tokens, none, lambda b, h: b.bitwiseXOR(_bits(h, planes)[k]))
    return [over(k) for k in range(planes)]


def _differ(x: str, y: str, planes: tuple[str, ...], least: Column) -> Column:
    """In how many classes of tokens the parity of two lines differs: in no more than they have words not in common.
    least: the words of the shorter line."""
    every, one, *more = (F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}")) for p in planes)
    if not more:
        return F.when(least > LONG, F.bit_count(every.bitwiseXOR(one)) + F.bit_count(one)).otherwise(F.bit_count(every))
    other, both = more
    parts = (one.bitwiseXOR(both), other.bitwiseXOR(both), both)
    return reduce(Column.__add__, map(F.bit_count, (reduce(Column.bitwiseXOR, parts, every), *parts)))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """cls, doc, rk, pos and (spaced) line of the first place of every distinct line with a word."""
    keyed = _keyed(docs).withColumn("text", spaced(F.col("text")))
    keyed = keyed.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "rk", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = keyed.where(F.ltrim("line") != "")
    keys = F.xxhash64("line").alias("cls"), F.xxhash64(F.lit("second"), "line").alias("cls2")
    return lines.groupBy(*keys).agg(F.min(F.struct("doc", "rk", "pos", "line")).alias("first")).select("cls", "first.*")


def with_prefix(lines: DataFrame, levels: Column, percent: int) -> DataFrame:
    """Adds own: n (distinct words), their parity bits and prefix (the tokens to post under, rarest first)."""
    none = F.xxhash64(F.lit(""))
    codes = F.array_remove(F.array_distinct(F.transform(F.split("line", " "), lambda w: F.xxhash64(w))), none)
    # A word's token: its rarity, then 55 bits of its hash. It is never null, and has to be known not to be: only then are
    # tokens sorted as longs, and not as objects that a comparator unwraps.
    token = lambda h: F.shiftleft(F.coalesce(F.get(levels, _bucket(h)), F.lit(0).cast("bigint")), 55).bitwiseOR(F.shiftrightunsigned(h, 9))
    # Columns used more than once stay columns of their own. So sets are made and sorted by compiled code, which is not so
    # for what stands below a lambda function.
    held = lines.withColumn("codes", codes)
    held = held.withColumns({"n": F.size("codes"), "tokens": F.sort_array(F.transform("codes", token))}).drop("codes")
    n, tokens = F.col("n"), F.col("tokens")
    # Where n of n + 1 words are too few, only equal sets are similar: those meet under the hash of all their tokens.
    alone = F.array(F.shiftrightunsigned(F.xxhash64(tokens), 1))
    first = F.slice(tokens, F.lit(1), n - F.floor((percent * n + 99) / 100).cast("int") + 1)
    prefix = F.when(n * (100 - percent) < percent, alone).otherwise(first)
    every, one = _parity(tokens, len(BITS))
    bits = every, F.when(n > LONG, one).otherwise(F.lit(0).cast("bigint"))
    own = F.struct("n", *(b.alias(x) for x, b in zip(BITS, bits)), prefix.alias("prefix"))
    return held.select(*lines.columns, own.alias("own"))


def postings(classes: DataFrame) -> DataFrame:
    """token, cls, n, place (from 1) and parity bits of every prefix token."""
    # What is read from files may be null as far as the plan knows; told that it isn't, the join of all postings tests no nulls.
    none = F.lit(0).cast("bigint")
    own = (F.coalesce(f"own.{x}", none).alias(x) for x in BITS)
    n = F.coalesce("own.n", F.lit(0)).alias("n")
    posts = classes.select(F.coalesce("cls", none).alias("cls"), n, *own, F.posexplode("own.prefix").alias("place", "token"))
    return posts.select(F.coalesce("token", none).alias("token"), "cls", "n", (F.col("place") + 1).alias("place"), *BITS)


def _able(x: str, y: str, percent: int, bits: tuple[str, ...]) -> Column:
    """Parity, length and positional filter for a token of two lines."""
    (nx, px), (ny, py) = ((F.col(f"{a}.n"), F.col(f"{a}.place")) for a in (x, y))
    near = (100 + percent) * _differ(x, y, bits, F.least(nx, ny)) <= (100 - percent) * (nx + ny)
    long = 100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)
    return near & long & ((100 + percent) * F.least(nx - px + 1, ny - py + 1) >= percent * (nx + ny))


def with_partner(posts: DataFrame, percent: int) -> DataFrame:
    """The postings, without parity bits, that some other line's posting in their list lets pass all filters."""
    x, y = posts.alias("x"), posts.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & _able("x", "y", percent, BITS) & (F.col("x.cls") != F.col("y.cls")), "left_semi")
    return met.drop(*BITS)


def _few(ids: DataFrame) -> DataFrame:
    """Ids marked for broadcast where they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _verified(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """cls of each x in pairs(x, y) whose words are similar enough to those of y."""
    of = lambda a: lines.select(F.col("cls").alias(a), F.col("words").alias(f"{a}w"))
    both = pairs.join(of("x"), "x").join(of("y"), "y")
    common = F.size(F.array_intersect("xw", "yw"))
    return both.where((100 + percent) * common >= percent * (F.size("xw") + F.size("yw"))).select(F.col("x").alias("cls")).distinct()


def _pairs(rest: DataFrame, others: DataFrame, on: list[str], percent: int) -> DataFrame:
    """(x, y): lines of rest with the lines before them in others that agree in `on` and pass all filters."""
    met = reduce(Column.__and__, (F.col(f"x.{k}") == F.col(f"y.{k}") for k in on))
    met = met & _able("x", "y", percent, WIDE) & (F.col("y.at") < F.col("x.at"))
    return rest.alias("x").join(others.alias("y"), met).select(F.col("x.cls").alias("x"), F.col("y.cls").alias("y")).distinct()


def _in_parts(posts: DataFrame) -> DataFrame:
    """Each posting in its random part of each division of its list. One hash names list and part, as one long is sorted by
    radix and two aren't; where two parts share it a star is larger or a pair is left to the lists."""
    parts = (F.xxhash64("token", F.lit(k), F.pmod(F.xxhash64("cls", F.lit(k)), F.lit(n))) for k, n in enumerate(PARTS))
    return posts.withColumn("part", F.explode(F.array(*parts)))


def similar_lines(classes: DataFrame, percent: int, few: int | None = None) -> DataFrame:
    """cls of every distinct line that an earlier one is similar to; few: the most files of a table on the way."""
    held = saved(with_partner(postings(classes), percent), few)
    ids = saved(held.select("cls").distinct(), few)

    lines = classes.select("cls", F.struct("doc", "rk", "pos").alias("at"), "line").join(_few(ids), "cls", "left_semi")
    words = lines = saved(lines.select("cls", "at", words_of(F.col("line")).alias("words")), few)
    # Words as rows: their parity is an aggregate in compiled code, and whole before the shuffle as a line lies in one task.
    hashes = lines.select("cls", F.explode("words").alias("word")).select("cls", F.xxhash64(F.lit("wide"), "word").alias("h"))
    wide = hashes.groupBy("cls").agg(*(F.bit_xor(b).alias(x) for x, b in zip(WIDE, _bits(F.col("h"), len(WIDE)))))
    known = lines.select("cls", "at").join(wide, "cls")
    posts = saved(held.join(known, "cls"), few)
    # The first line of a part is a partial maximum, not a window: a list of any length is dealt over all tasks.
    parted = _in_parts(posts)
    heads = parted.groupBy("part").agg(F.min(F.struct("at", "cls", "n", "place", *WIDE)).alias("first")).select("part", "first.*")
    settled = saved(_verified(_pairs(parted, heads, ["part"], percent), words, percent), few)
    rest = posts.join(_few(settled), "cls", "left_anti")
    more = saved(_verified(_pairs(rest, posts, ["token"], percent), words, percent), few)
    for done in (held, ids, lines, posts):
        discard(done)
    return settled.union(more)


def kept_places(docs: DataFrame, percent: int) -> DataFrame:
    """rk and the places of the lines with words that stay, for each document that has any."""
    classes = saved(with_prefix(distinct_lines(docs), rarity(docs), percent), None, True)
    few = files_for(classes.count())
    similar = similar_lines(classes, percent, few)
    kept = classes.select("cls", "rk", "pos").join(_few(similar), "cls", "left_anti")
    places = saved(kept.groupBy("rk").agg(F.collect_list("pos").alias("kept")), few)
    discard(classes)
    return places


def _worded(lines: Column) -> Column:
    """The places of the lines that have a word."""
    return F.filter(F.transform(lines, lambda line, i: F.when(has_word(line), i)), lambda i: i.isNotNull())


def _with_removed(docs: DataFrame, places: DataFrame) -> DataFrame:
    """docs(.., worded, rk) with the places of the lines that go."""
    none = F.array().cast("array<int>")
    removed = F.coalesce(F.sort_array(F.array_except("worded", F.coalesce("kept", none))), none)
    return docs.join(places, "rk", "left").withColumn("removed", removed).drop("worded", "kept")


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines, n_removed and the places (from 0) of the removed lines of every row."""
    docs = docs.select("doc_id", "text")
    places = kept_places(docs, percent)
    n_lines = F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("long")
    # Lines are counted before the join, so that no text goes through it.
    split = _keyed(docs).withColumn("lines", F.split("text", "\n")).select("doc_id", "rk", n_lines.alias("n_lines"), _worded(F.col("lines")).alias("worded"))
    return _with_removed(split, places).select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with the removed lines taken out of text; a document that loses its last word goes."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc, text = (names[[c.lower() for c in docs.columns].index(x)] for x in ("doc_id", "text"))
    places = kept_places(docs.select("doc_id", "text"), percent)
    # Lines are split before the join, so that they are a column, and not an expression, for what looks lines up by their place.
    split = plain.withColumn("rk", F.xxhash64(F.col(doc).cast("long"), text)).withColumn("lines", F.split(text, "\n"))
    told = _with_removed(split.withColumn("worded", _worded(F.col("lines"))).drop(text), places)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    rest = F.when(F.size("removed") == 0, F.col("lines")).otherwise(F.transform(stay, lambda i: F.element_at("lines", i + 1)))
    now = told.withColumn("now", F.array_join(rest, "\n"))
    now = now.where((F.size("removed") == 0) | F.col("now").rlike(r"[^ \t\n\x0B\f\r]"))
    return now.select(*(F.col("now" if n == text else n).alias(c) for n, c in zip(names, docs.columns)))
