"""Near-duplicate lines by a segment-partition edit join. DataFrame functions only.

A line is cut into one segment more than the edits allowed, so a line within that distance holds
one of the segments unchanged, at a place that its length and the segment's rank pin down to a few
starts. Segments go into an index by length, rank and content; the other line's substrings at
those starts probe it; pairs that meet are verified by a banded bit-parallel edit distance.

The edits allowed grow with the shorter line, in classes of length (``CLASSES``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import stored
from churnspark.llm.components import components

#: (from this length, below that length, edits). Two edits from 20 characters on and one more at
#: 400 and at every fourfold length; the number of probes grows with the cube of the edits.
CLASSES = ((8, 20, 1), (20, 400, 2), (400, 1600, 3), (1600, 6400, 4), (6400, 25_600, 5),
           (25_600, 102_400, 6), (102_400, 409_600, 7), (409_600, None, 8))
#: Lines below so many characters take part only if they hold a letter or digit.
SHORT = 20
#: So many ids of lines (8 bytes each) are sent to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
A_WORD = r"[\p{L}\p{N}]"

Classes = Sequence[tuple[int, int | None, int]]


def fixed(edits: int, least: int) -> Classes:
    """The same number of edits for all lines of at least so many characters."""
    return ((least, None, edits),)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, doc_hash, lines: the document rows; equal rows are one document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("doc_hash"),
                       F.split(text, "\n").alias("lines"))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, doc_hash, at, line, id, n: every line of enough characters, which must hold a word
    if it is short; id, a hash of 63 bits, names its content."""
    # The length is taken before the lines are dealt out, or every later use would count anew.
    sized = F.transform("lines", lambda x: F.struct(x.alias("line"), F.length(x).alias("n")))
    return (_rows(docs).select("doc_id", "doc_hash", F.posexplode(sized).alias("at", "e"))
            .select("doc_id", "doc_hash", "at", "e.line", "e.n").where(F.col("n") >= min_chars)
            .where((F.col("n") >= SHORT) | F.col("line").rlike(A_WORD))
            .withColumn("id", F.call_function("shiftrightunsigned", F.xxhash64("line"), F.lit(1))))


def probe_places(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of every place a matching segment may have.

    Seen from the left, a segment can have moved by as many edits as stand before it; seen from
    the right, by as many as are left for what follows; both must hold.
    """
    return [(longer, i, shift)
            for longer in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, longer - (edits - i)), min(i, longer + edits - i) + 1)]


def _places(classes: Classes, at: int) -> list[tuple[int, ...]]:
    """(edits, from, below, difference, segment, shift, probe) of what a line of class ``at`` puts
    in: its own segments, and substrings for lines of its class and of the one below it."""
    top = (1 << 31) - 1
    out = []
    for i in range(max(0, at - 1), at + 1):
        low, high, edits = classes[i]
        if i == at:
            out += [(edits, low, high or top, 0, segment, 0, 0) for segment in range(edits + 1)]
        out += [(edits, low, high or top, longer, segment, shift, 1)
                for longer, segment, shift in probe_places(edits) if i == at or longer]
    return out


def _entry(place: Column) -> tuple[Column, Column]:
    """Whether a line of n characters has such a place, and the key found there; ``wide`` has four
    bytes for each character, so that a substring is found without counting characters."""
    n, parts = F.col("n"), place["edits"] + 1
    length = n - place["longer"]
    size, rest = F.floor(length / parts).cast("int"), length % parts
    long = place["segment"] >= parts - rest  # the last segments take what is left over
    start = place["segment"] * size + F.greatest(F.lit(0), place["segment"] - (parts - rest))
    at, size = start + place["shift"], size + F.when(long, 1).otherwise(0)
    fits = (length >= place["low"]) & (length < place["high"]) & (at >= 0) & (at + size <= n)
    return fits, F.xxhash64(length, place["segment"], F.substr("wide", at * 4 + 1, size * 4))


def _keys(lines: DataFrame, classes: Classes) -> DataFrame:
    """(k, code): hashed segments of each line and hashed substrings that look for them.

    ``code`` is twice the line's id, one more for a substring that looks.
    """
    names = ("edits", "low", "high", "longer", "segment", "shift", "probe")
    kind = "array<struct<" + ",".join(f"{c}:int" for c in names) + ">>"
    # Places are dealt out before their keys are made: that runs as compiled code, a function over
    # an array would not. The table is chosen by the length of ``wide``, so that ``wide`` is made
    # before the places are dealt out, once a line.
    wanted, n = None, F.floor(F.length("wide") / 4)
    for i, (low, high, _) in enumerate(classes):
        table = F.from_json(F.lit(json.dumps([
            dict(zip(names, place, strict=True)) for place in _places(classes, i)])), kind)
        own = (n >= low) & (F.lit(True) if high is None else n < high)
        wanted = F.when(own, table) if wanted is None else wanted.when(own, table)
    fits, key = _entry(F.col("place"))
    return (lines.select("id", "n", F.encode("line", "UTF-32").alias("wide"))
            .select("id", "n", "wide", F.explode(wanted).alias("place")).where(fits)
            .select(key.alias("k"), F.call_function("shiftleft", F.col("id"), F.lit(1))
                    .bitwiseOR(F.col("place.probe").cast("long")).alias("code")))


def chars_of(line: str) -> Column:
    return F.filter(F.split(line, ""), lambda c: c != "")


def signature(chars: Column) -> Column:
    """64 parities of hashed neighbouring characters; an edit changes four of them at most."""
    return F.aggregate(
        chars, F.struct(F.lit(0).alias("before"), F.lit(0).cast("long").alias("bits")),
        lambda acc, c: F.struct(
            F.ascii(c).alias("before"),
            acc["bits"].bitwiseXOR(F.call_function(
                "shiftleft", F.lit(1).cast("long"),
                ((acc["before"] * 37 + F.ascii(c)) % 64).cast("int"))).alias("bits")),
        lambda acc: acc["bits"])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edit_distance(longer: Column, shorter: Column, edits: int) -> Column:
    """Edit distance of two arrays of characters if it is ``edits`` at most, else more than that.

    Hyyro's bit-vectors over a band of 2 * edits + 1 diagonals, kept in the highest bits of a
    long: one column of the table for each character of the shorter array. The first array must
    not be the shorter one, nor longer by more than ``edits``, and holds ``edits`` characters.
    """
    top = F.lit(-(1 << 63)).cast("long")
    one = F.lit(1).cast("long")

    def step(acc, i):
        matches = F.lit(0).cast("long")
        for d in range(2 * edits + 1):
            same = F.get(longer, i + edits - d).eqNullSafe(F.get(shorter, i))
            bit = -(1 << 63) if d == 0 else 1 << (63 - d)
            matches = matches.bitwiseOR(F.when(same, F.lit(bit)).otherwise(F.lit(0)))
        vp, vn, dist = acc["vp"], acc["vn"], acc["dist"]

        def columns(x):
            total = _wrapping_add(x.bitwiseAND(vp), vp)
            return _let(total.bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn), after)

        def after(d0):
            hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            return _let(F.struct(d0.alias("d0"), hp.alias("hp"), hn.alias("hn")), finish)

        def finish(s):
            d0, hp, hn = s["d0"], s["hp"], s["hn"]
            half = F.call_function("shiftrightunsigned", d0, F.lit(1))
            diagonal = i < F.size(longer) - edits
            mask = F.call_function("shiftleft", one,
                                   (F.lit(62) - (i - (F.size(longer) - edits))).cast("int"))
            change = F.when(diagonal, F.when(d0.bitwiseAND(top) == 0, 1).otherwise(0)).otherwise(
                F.when(hp.bitwiseAND(mask) != 0, 1).otherwise(0)
                - F.when(hn.bitwiseAND(mask) != 0, 1).otherwise(0))
            return F.struct(hn.bitwiseOR(F.bitwise_not(half.bitwiseOR(hp))).alias("vp"),
                            half.bitwiseAND(hp).alias("vn"), (dist + change).alias("dist"))

        return _let(matches, columns)

    start = F.struct(F.call_function("shiftleft", F.lit(-1).cast("long"), F.lit(63 - edits))
                     .alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(edits).alias("dist"))
    return F.when(F.size(shorter) == 0, F.size(longer)).otherwise(F.aggregate(
        F.sequence(F.lit(0), F.size(shorter) - 1), start, step, lambda acc: acc["dist"]))


def _wrapping_add(a: Column, b: Column) -> Column:
    """a + b modulo 2^64, which plain addition refuses when it overflows.

    The low 62 bits and the two highest ones are added apart, with the carry between them.
    """
    low, high = F.lit((1 << 62) - 1), F.lit(62)
    return _let(F.struct((a.bitwiseAND(low) + b.bitwiseAND(low)).alias("s"),
                         F.call_function("shiftrightunsigned", a, high).alias("x"),
                         F.call_function("shiftrightunsigned", b, high).alias("y")),
                lambda v: F.call_function(
                    "shiftleft", v["x"] + v["y"] + F.call_function(
                        "shiftrightunsigned", v["s"], high), high)
                .bitwiseOR(v["s"].bitwiseAND(low)))


def edits_of(n: Column, classes: Classes) -> Column:
    """Edits that a line of n characters allows; null below the first class."""
    out = None
    for low, high, edits in classes:
        own = (n >= low) & (F.lit(True) if high is None else n < high)
        out = F.when(own, edits) if out is None else out.when(own, edits)
    return out


def near_lines(lines: DataFrame, classes: Classes = CLASSES) -> DataFrame:
    """(u, v): ids of different lines within the edits of the shorter one, u the shorter one (of
    equal lengths, both orders); ``lines`` has line, id and n.

    Equal lines are collapsed before they give keys. Keys that only one line holds, or that nobody
    looks for, go in the shuffle's reduce side; texts are read again for the lines that are left.
    """
    usual = lines.where(F.col("n") >= classes[0][0])
    kinds = usual.groupBy("id", "line", "n").agg(F.count("*").alias("copies"))
    one, probe = Window.partitionBy("k"), F.col("code").bitwiseAND(F.lit(1)) != 0
    ident = F.call_function("shiftrightunsigned", F.col("code"), F.lit(1))
    met = (_keys(kinds, classes).withColumn("id", ident).withColumn("probe", probe)
           .withColumn("low", F.min("id").over(one)).withColumn("high", F.max("id").over(one))
           .withColumn("asked", F.max("probe").over(one))
           .withColumn("held", F.min("probe").over(one))
           .where("low <> high AND asked AND NOT held").select("k", "id", "probe"))
    met = stored(met, "line-keys")
    wanted = stored(met.select("id").distinct(), "line-wanted")
    if wanted.count() <= BROADCAST_IDS:  # else both sides are shuffled
        wanted = F.broadcast(wanted)
    chars = chars_of("line")
    texts = stored(lines.select("id", "line", "n").join(wanted, "id", "left_semi")
                   .groupBy("id", "line", "n").agg(F.count("*").alias("copies"))
                   .select("id", "n", "line", signature(chars).alias("bits")), "line-texts")
    known = met.join(texts, "id")
    held = known.where("NOT probe").select(
        "k", F.col("id").alias("u"), F.col("bits").alias("bu"), F.col("line").alias("short"),
        edits_of(F.col("n"), classes).alias("edits"))
    asked = known.where("probe").select("k", F.col("id").alias("v"), F.col("bits").alias("bv"),
                                        F.col("line").alias("long"))
    close = F.bit_count(F.col("bu").bitwiseXOR(F.col("bv"))) <= 4 * F.col("edits")
    # Most pairs that meet hold a moved or replaced word and are far apart. The built-in distance,
    # which gives up at the limit, clears them inside the join, so they are never listed.
    likely = F.call_function("levenshtein", "short", "long", "edits") >= 0
    pairs = stored(held.join(asked, (held.k == asked.k) & (held.u != asked.v) & close & likely)
                   .select("u", "v", "edits").distinct(), "line-pairs")
    # The characters come from a stored table: an expression for them would be evaluated again in
    # every step of the distance.
    both = stored(pairs.join(texts.select(F.col("id").alias("u"), F.col("line").alias("short")), "u")
                  .join(texts.select(F.col("id").alias("v"), F.col("line").alias("long")), "v")
                  .select("u", "v", "edits", chars_of("short").alias("shorter"),
                          chars_of("long").alias("longer")), "line-likely")
    within = None  # probes come from the line that is not the shorter one
    for edits in sorted({c[2] for c in classes}):
        distance = edit_distance(F.col("longer"), F.col("shorter"), edits)
        own = F.col("edits") == edits
        within = F.when(own, distance) if within is None else within.when(own, distance)
    return both.where(within <= F.col("edits")).select("u", "v")


def repeated_lines(docs: DataFrame, classes: Classes = CLASSES, min_chars: int = 1) -> DataFrame:
    """doc_id, doc_hash, at: lines that go, being near-duplicates of an earlier line.

    Lines reachable by steps of the allowed edits or fewer are one group; its first line, by
    doc_id, a hash of the text, and line number, stays. Lines below the first class are compared
    for equality only; those below ``min_chars``, and those below ``SHORT`` without a letter or
    digit, are left alone. Null doc_ids come first. Repeated rows of
    one doc_id and text are one document, whose lines go or stay in all of them.
    """
    lines = _lines(docs, min_chars)
    roots = components(stored(near_lines(lines, classes), "line-links"))
    place = F.struct("doc_id", "doc_hash", "at")
    firsts = lines.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    firsts = stored(firsts, "line-firsts")
    rooted = (firsts.join(roots.toDF("id", "root"), "id", "left")
              .withColumn("root", F.coalesce("root", "id")))
    groups = rooted.groupBy("root").agg(F.min("first").alias("keep"), F.count("*").alias("kinds"))
    judged = (rooted.join(groups, "root").where("kinds > 1 OR copies > 1").select("id", "keep"))
    return (lines.select("id", "doc_id", "doc_hash", "at").join(judged, "id")
            .where(~place.eqNullSafe(F.col("keep")))
            .select("doc_id", "doc_hash", "at").distinct())


def _removed(docs: DataFrame, classes: Classes, min_chars: int) -> DataFrame:
    return (repeated_lines(docs, classes, min_chars).groupBy("doc_id", "doc_hash")
            .agg(F.sort_array(F.collect_list("at")).alias("removed")))


def line_report(docs: DataFrame, classes: Classes = CLASSES, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 0) of each document.

    Null and empty texts have one empty line, which stays. One row for each input row. Other
    columns are ignored.
    """
    gone = _removed(docs, classes, min_chars)
    rows = _rows(docs).select("doc_id", "doc_hash", F.size("lines").cast("long").alias("n_lines"))
    same = (rows["doc_id"].eqNullSafe(gone["doc_id"])) & (rows["doc_hash"] == gone["doc_hash"])
    return rows.join(gone, same, "left").select(
        rows["doc_id"], "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long")
        .alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def drop_lines(docs: DataFrame, classes: Classes = CLASSES, min_chars: int = 1) -> DataFrame:
    """The documents, all columns, without the lines that go; n_chars follows if there is one."""
    gone = _removed(docs, classes, min_chars).select(
        F.col("doc_id").alias("gone_id"), F.col("doc_hash").alias("gone_hash"), "removed")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    joined = whole.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("gone_id")) & (
        F.xxhash64(F.coalesce("doc.text", F.lit(""))) == F.col("gone_hash")), "left")
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.concat_ws(
        "\n", F.filter(F.split("doc.text", "\n"),
                       lambda line, i: ~F.array_contains("removed", i))))
    new = joined.select("doc", text.alias("new_text"))
    return new.select(*(
        F.col("new_text").alias(c) if c == "text"
        else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
