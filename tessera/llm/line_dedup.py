"""Fuzzy line dedup with DataFrame functions alone.

Lines are normalised (lower case, ASCII that is no letter or digit to one space, digit runs to 0) and
made distinct by their whole normalised text. A distinct line's fingerprint is a row of SimHash blocks: each distinct
word votes, with the bits of its XXH64, in the one block that its hash names. A changed word
so disturbs two blocks at most and leaves the others bit for bit as they were, wherever it
stands. Lines are candidates if enough blocks agree (pigeonhole):

- lines of up to 13 words: 2 of 4 blocks;
- of 10 to 63: 2 of 5;
- of 50 on: 1 of 8 blocks, of twice as many blocks for twice as many words.

The ranges overlap, so that two lines whose word counts are within a fifth share a scheme. Blocks of too few
words are no key: an empty one of 8, two that together have not even one block's share. Candidates whose SimHashes of the whole
line differ in 14 bits of 64 or fewer (12 from 32 words on, 10 from 64) and whose edit similarity is 0.8 or more are linked,
and of every connected group the first occurrence (smallest doc_id, then line number) stays.

Each line is first judged against one leader: of the smallest lines of its keys the one with most keys
in common; then, for three turns, those that share a key with lines of other groups against a leader drawn anew. Only pairs that share
a key, are within the radius and are still in different groups are then compared one by one, so a large
group of variants costs its size and not its square, and no link is lost.

Defined cases: lines without letters and digits are always kept; null and empty texts have one
empty line; a null id sorts before all others; rows that repeat an id count as one document
whose lines are numbered on in the order of the texts' hashes; rows that repeat id and text are
one document whose result each of them gets; an empty table gives no rows;
other columns are ignored by `decisions` and kept by `drop_lines`, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, scratch, written
from .components import components

SIMILARITY = 0.8
#: Words that a block counts; the mean of a block's words is below 14, and a block is drawn by hash.
BLOCK_WORDS = 63
#: Bits of a block by eights, where two of them are a key and where one is.
PAIR_SUMS, LONE_SUMS = 3, 5
#: Blocks of which two must agree, and the least and most words of such lines.
TWO_OF = ((4, 0, 13), (5, 10, 63))
#: Words from which 1 of 8 blocks must agree, and those below which this scheme is used.
ONE_FROM, ONE_TO = 50, 128
#: Differing bits of 64 that the SimHashes of two whole lines may have, by the least words that the shorter has: the more words,
#: the less a changed one turns.
RADIUS = ((0, 14), (32, 12), (64, 10))

#: Turns in which lines still apart meet a leader drawn anew; they save work and change no result.
LEADERS = 3

_ONES = {8: 0x0101010101010101, 16: 0x0001000100010001, 32: 0x0000000100000001}


def normalised(text: Column) -> Column:
    """Every line of a text normalised, but for spaces at its ends. Spaces alone are left to the second step, which rarely finds two."""
    plain = F.regexp_replace(F.lower(text), r"[\x00-\x09\x0B-\x1F!-/:-`{-\x7F]+", " ")
    return F.regexp_replace(F.regexp_replace(plain, " {2,}", " "), "[0-9]+", "0")


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines with letters or digits: doc_id, th (hash of the text), line_no from 0, norm."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("tx"))
    rows = rows.select("doc_id", F.xxhash64("tx").alias("th"), F.split(normalised(F.col("tx")), "\n", -1).alias("ls"))
    # The outer form, whose plan has no filter that would split and normalise again.
    lines = rows.select("doc_id", "th", F.posexplode_outer("ls").alias("line_no", "line"))
    return lines.select("doc_id", "th", "line_no", F.trim("line").alias("norm")).where("norm <> ''")


def _counted(k: int, width: int):
    """Adds bits k, k + width and so on of a hash to counters of `width` bits."""
    return lambda s, h: s + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONES[width]).cast("bigint"))


def simhash(hashes: Column, sums: int, width: int = 8) -> Column:
    """Of the hashes' bits k, k + width and so on, k < sums, which over half of the hashes have; there must be fewer than 2 ** (width - 2).

    Each sum holds 64 / width counters. What half of the hashes lacks to the top but one bit of a counter is added
    to all, and that bit then says whether a count was over half.
    """
    ones = F.lit(_ONES[width]).cast("bigint")
    lift = (F.lit((1 << (width - 2)) - 1) - F.call_function("shiftright", F.size(hashes), F.lit(1))).cast("bigint") * ones
    out = F.lit(0).cast("bigint")
    for k in range(sums):
        count = F.aggregate(hashes, F.lit(0).cast("bigint"), _counted(k, width))
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(count + lift, width - 2).bitwiseAND(ones), k))
    return out


def whole_print(hashes: Column) -> Column:
    """The 64-bit SimHash of any number of hashes."""
    n = F.size(hashes)
    return F.when(n <= BLOCK_WORDS, simhash(hashes, 8)).when(n < 1 << 14, simhash(hashes, 16, 16)).otherwise(simhash(hashes, 32, 32))


def _cut(ranked: str, after: Column, before: Column) -> Column:
    """The elements between two positions."""
    return F.slice(ranked, after + 1, F.least(before - after - 1, F.lit(BLOCK_WORDS)))


def _two_of(lines: DataFrame, blocks: int, least: int, most: int) -> DataFrame:
    """(nid, key) for every two blocks that together have a block's share of the words; hashes and the blocks' bounds are ranked together."""
    bounds = [F.lit((j << 64) // blocks - (1 << 63)).cast("bigint") for j in range(1, blocks)]
    ranked = lines.where(F.col("n").between(least, most)).select("nid", F.size("hs").alias("m"), F.sort_array(F.concat("hs", F.array(*bounds))).alias("r"))
    placed = ranked.select("nid", "m", "r", F.lit(0).alias("p0"), *[F.array_position("r", x).cast("int").alias(f"p{j}") for j, x in enumerate(bounds, 1)], (F.size("r") + 1).alias(f"p{blocks}"))
    cut = placed.select("nid", "m", *[_cut("r", F.col(f"p{j}"), F.col(f"p{j + 1}")).alias(f"w{j}") for j in range(blocks)])
    prints = cut.select("nid", "m", *[F.size(f"w{j}").alias(f"n{j}") for j in range(blocks)], *[simhash(F.col(f"w{j}"), PAIR_SUMS).alias(f"f{j}") for j in range(blocks)])
    keys = [F.when((F.col(f"n{i}") + F.col(f"n{j}")) * blocks >= F.col("m"), F.xxhash64(F.lit(blocks << 16 | i << 8 | j), f"f{i}", f"f{j}")) for i, j in combinations(range(blocks), 2)]
    return prints.select("nid", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")


def _one_of(lines: DataFrame) -> DataFrame:
    """(nid, key) for each of the 2 ** bits blocks that isn't empty; hashes and the blocks' bounds are ranked together."""
    blocks = F.call_function("shiftleft", F.lit(1), F.col("bits"))
    bound = lambda j: F.call_function("shiftleft", j.cast("bigint"), F.lit(64) - F.col("bits")).bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
    bounds = F.transform(F.sequence(F.lit(1), blocks - 1), bound)
    ranked = lines.select("nid", "bits", F.sort_array(F.concat("hs", bounds)).alias("r"), bounds.alias("bounds"))
    ends = F.concat(F.array(F.lit(0)), F.transform("bounds", lambda x: F.array_position(F.col("r"), x).cast("int")), F.array(F.size("r") + 1))
    placed = ranked.select("nid", "bits", "r", ends.alias("ends"))
    each = placed.select("nid", "bits", "r", "ends", F.explode(F.sequence(F.lit(1), F.size("ends") - 1)).alias("j"))
    cut = each.select("nid", "bits", "j", _cut("r", F.element_at("ends", F.col("j")), F.element_at("ends", F.col("j") + 1)).alias("w"))
    return cut.where("size(w) > 0").select("nid", F.xxhash64("bits", "j", simhash(F.col("w"), LONE_SUMS)).alias("key"))


def _hashes(norm: str) -> Column:
    """Of the distinct words."""
    return F.transform(F.array_distinct(F.split(norm, " ")), lambda w: F.xxhash64(w))


def _count(norm: str) -> Column:
    """Words of a normalised line."""
    return F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1


def block_keys(distinct: DataFrame) -> DataFrame:
    """(nid, key) for every key of every line `norm`."""
    sized = distinct.select("nid", "norm", _count("norm").alias("n"))
    hashed = sized.select("nid", "n", _hashes("norm").alias("hs"))
    own = F.floor(F.log2(F.col("n") / ONE_FROM + F.lit(1e-9))).cast("int") + 3
    longer = hashed.where(F.col("n") >= ONE_FROM).withColumn("bits", own)
    # Lines of fewer words may share only the level below.
    both = F.when((F.col("bits") > 3) & (F.col("n") < F.call_function("shiftleft", F.lit(ONE_TO), F.col("bits") - 4)), F.array("bits", F.col("bits") - 1)).otherwise(F.array("bits"))
    longer = longer.select("nid", "hs", F.explode(both).alias("bits"))
    parts = [_two_of(hashed, *scheme) for scheme in TWO_OF]
    return parts[0].unionByName(parts[1]).unionByName(_one_of(longer))


def judged(pairs: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """pairs with `linked`: edit similarity 1 - distance / longer length of columns a and b is at least `least`.

    Words are compared from the front and from the back. Where the word counts agree, the lengths of the words that differ bound
    the distance; where they don't, a split of the words into a front and a back bounds it, the words left between them being
    no longer than the difference of the lines and of the words that differ. That settles most. Of the rest, words that
    both begin or end with are left out, which changes no distance, and what is left is measured within
    a quarter of the distance allowed first, which costs a quarter.
    """
    longer = F.greatest(F.length(a), F.length(b))
    step = pairs.withColumn("_most", F.floor(longer * F.lit(1 - least) + F.lit(1e-9)).cast("int"))
    step = step.withColumn("_apart", F.abs(F.length(a) - F.length(b)))
    step = step.withColumn("_fits", F.col("_apart") <= F.col("_most"))
    step = step.withColumn("_wa", F.when(F.col("_fits"), F.split(a, " "))).withColumn("_wb", F.when(F.col("_fits"), F.split(b, " ")))
    step = step.withColumn("_n", F.least(F.size("_wa"), F.size("_wb")))
    differ = lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.length(x), F.length(y)))
    step = step.withColumn("_front", F.zip_with(F.slice("_wa", 1, F.col("_n")), F.slice("_wb", 1, F.col("_n")), differ))
    last = [F.slice(w, F.size(w) - F.col("_n") + 1, F.col("_n")) for w in ("_wa", "_wb")]
    step = step.withColumn("_back", F.when(F.size("_wa") == F.size("_wb"), F.col("_front")).otherwise(F.zip_with(*last, differ)))
    total = F.aggregate("_back", F.lit(0), lambda s, x: s + x)
    step = step.withColumn("_total", total)
    # (front up to here and back from here on, the least such sum)
    start = F.struct(F.col("_total").alias("now"), F.col("_total").alias("least"))

    def moved(s: Column, x: Column) -> Column:
        now = s["now"] + x["_front"] - x["_back"]
        return F.struct(now.alias("now"), F.least(s["least"], now).alias("least"))

    split = F.aggregate(F.arrays_zip("_front", "_back"), start, moved, lambda s: s["least"])
    bound = F.when(F.size("_wa") == F.size("_wb"), F.col("_total")).otherwise(split * 2 + F.col("_apart"))
    step = step.withColumn("_sure", F.coalesce(bound <= F.col("_most"), F.lit(False)))
    open_ = F.col("_fits") & ~F.col("_sure")
    # Words alike at the front, and at the back of what is left.
    front = F.array_position(F.transform("_front", lambda x: x > 0), F.lit(True)).cast("int")
    step = step.withColumn("_p", F.when(open_, F.when(front == 0, F.col("_n")).otherwise(front - 1)))
    back = F.array_position(F.transform(F.reverse("_back"), lambda x: x > 0), F.lit(True)).cast("int")
    step = step.withColumn("_q", F.least(F.when(back == 0, F.col("_n")).otherwise(back - 1), F.col("_n") - F.col("_p")))
    for side in "ab":
        middle = F.slice(f"_w{side}", F.col("_p") + 1, F.size(f"_w{side}") - F.col("_p") - F.col("_q"))
        step = step.withColumn(f"_m{side}", F.array_join(middle, " "))
    # One middle may be empty; the space that its neighbour then has more counts as one.
    spare = F.when((F.length("_ma") == 0) != (F.length("_mb") == 0), 1).otherwise(0)
    step = step.withColumn("_left", F.greatest(F.length("_ma"), F.length("_mb")) + spare)
    linked = F.when(~F.col("_fits"), False).when(F.col("_sure") | (F.col("_left") <= F.col("_most")), True).when(spare == 1, False)
    linked = linked.when(F.expr("levenshtein(_ma, _mb, _most div 4) >= 0"), True).otherwise(F.expr("levenshtein(_ma, _mb, _most) >= 0"))
    own = ("_most", "_apart", "_fits", "_wa", "_wb", "_n", "_front", "_back", "_total", "_sure", "_p", "_q", "_ma", "_mb", "_left")
    return step.withColumn("linked", linked).drop(*own)


def _close(x: str, y: str) -> Column:
    """Whether fp and n of both sides, suffixed x and y, are within the radius."""
    n = F.least(f"n_{x}", f"n_{y}")
    most = F.lit(RADIUS[0][1])
    for least, bits in RADIUS[1:]:
        most = F.when(n >= least, bits).otherwise(most)
    return F.bit_count(F.col(f"fp_{x}").bitwiseXOR(F.col(f"fp_{y}"))) <= most


def groups(distinct: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of the lines `nid` with text `norm` that some link joins; component is the smallest nid of the group."""
    with scratch():
        whole = block_keys(distinct).selectExpr("key", "nid", "count(*) OVER (PARTITION BY key) AS n", "min(nid) OVER (PARTITION BY key) AS lead").where("n > 1")
        shared = written(whole.select("key", "nid", "lead"), "line-keys", codec="none")
        wanted = distinct.select("nid", "norm").join(shared.select("nid").distinct(), "nid", "left_semi")
        texts = written(wanted.withColumn("hs", _hashes("norm")).select("nid", "norm", _count("norm").alias("n"), whole_print(F.col("hs")).alias("fp")), "line-texts")
        a, b = (texts.select(F.col("nid").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("norm", "n", "fp")]) for x in "ab")

        def linked(pairs: DataFrame, name: str) -> DataFrame:
            both = pairs.join(b, "b").join(a, "a").where(_close("a", "b"))
            # Written before it is filtered: a filter would be pushed down and repeat the judgement's steps.
            return written(judged(both, "norm_a", "norm_b", similarity).select("a", "b", "linked"), name, codec="none").where("linked").select("a", "b")

        met = shared.where("nid <> lead").groupBy("nid", "lead").count()
        best = met.groupBy("nid").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("a")).select("a", F.col("nid").alias("b"))
        links = linked(best, "line-links")
        sizes = texts.select("nid", "n", "fp", F.length("norm").alias("size"))
        fits = lambda x, y: (F.abs(F.col(f"size_{x}") - F.col(f"size_{y}")) <= F.greatest(f"size_{x}", f"size_{y}") * F.lit(1 - similarity) + F.lit(1e-9)) & _close(x, y)
        for turn in range(1, LEADERS + 2):
            of = sizes.join(components(links).withColumnRenamed("node", "nid"), "nid", "left").withColumn("c", F.coalesce("component", "nid")).drop("component")
            of = shared.select("key", "nid").join(of, "nid").selectExpr("*", "min(c) OVER (PARTITION BY key) AS low", "max(c) OVER (PARTITION BY key) AS high")
            # Keys whose lines are all in one group have nothing left to compare.
            of = written(of.where("low <> high").drop("low", "high"), "line-apart", codec="none")
            x, y = (of.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("nid", "c", "size", "n", "fp")]) for side in "xy")
            if turn <= LEADERS:
                lead = x.groupBy("key").agg(F.min_by(F.struct(*[c for c in x.columns if c != "key"]), F.xxhash64(F.lit(turn), F.col("nid_x"))).alias("lead")).select("key", "lead.*")
                met = y.join(lead, "key").where((F.col("c_x") != F.col("c_y")) & fits("x", "y")).groupBy("nid_y", "nid_x").count()
                pairs = met.groupBy(F.col("nid_y").alias("b")).agg(F.max_by("nid_x", F.struct("count", -F.col("nid_x"))).alias("a"))
            else:
                apart = x.join(y, (x["key"] == y["key"]) & (F.col("nid_x") < F.col("nid_y")) & (F.col("c_x") != F.col("c_y")) & fits("x", "y"))
                pairs = apart.select(F.col("nid_x").alias("a"), F.col("nid_y").alias("b")).distinct()
            links = links.unionByName(linked(pairs, "line-more-links"))
        return written(components(links), "line-groups", codec="none", keep=True)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, dropped (line numbers in order)."""
    return _decided(docs, id_col, text_col, similarity).drop("th")


def _decided(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    with scratch():
        lines = occurrences(docs, id_col, text_col).withColumn("l1", F.xxhash64("norm"))
        distinct = lines.groupBy("l1", "norm").agg(F.min(F.struct("doc_id", "th", "line_no")).alias("first"))
        distinct = written(distinct.select(F.monotonically_increasing_id().alias("nid"), "norm", "first"), "distinct-lines")
        joined = groups(distinct, similarity)
        member = joined.withColumnRenamed("node", "nid").join(distinct.select("nid", "first"), "nid")
        late = member.join(member.groupBy("component").agg(F.min("first").alias("keep")), "component").where("first <> keep").select("nid")
        stay = distinct.select("nid", "first.*").join(late, "nid", "left_anti")
        stay = written(stay.groupBy("doc_id", "th").agg(F.collect_list("line_no").alias("stay")), "kept-lines", keep=True)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_x"), F.coalesce(F.col(text_col), F.lit("")).alias("tx"))
    rows = rows.select("id_x", F.xxhash64("tx").alias("th_x"), F.split("tx", "\n", -1).alias("ls"))
    full = F.filter(F.transform("ls", lambda x, i: F.when(x.rlike(r"[^\x00-/:-@\[-`{-\x7F]"), i)), lambda i: i.isNotNull())
    rows = rows.select("id_x", "th_x", F.size("ls").cast("bigint").alias("n_lines"), full.alias("full"))
    whole = rows.join(stay, rows["id_x"].eqNullSafe(stay["doc_id"]) & (rows["th_x"] == stay["th"]), "left")
    dropped = F.array_sort(F.array_except("full", F.coalesce("stay", F.array().cast("array<int>"))))
    whole = whole.select(F.col("id_x").alias("doc_id"), F.col("th_x").alias("th"), "n_lines", dropped.alias("dropped"))
    return whole.select("doc_id", "th", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"), "dropped")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs without the dropped lines of each text, all columns kept; null texts stay null."""
    gid, gth, gone = (free_name(x, docs.columns) for x in ("gone_id", "gone_th", "gone_lines"))
    found = _decided(docs, id_col, text_col, similarity).select(F.col("doc_id").alias(gid), F.col("th").alias(gth), F.col("dropped").alias(gone)).distinct()
    th = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    joined = docs.join(found, docs[id_col].cast("bigint").eqNullSafe(found[gid]) & (th == found[gth]), "left")
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains(F.col(gone), i))
    return joined.withColumn(text_col, F.array_join(kept, "\n")).select(*docs.columns)
