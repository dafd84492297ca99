"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct `shingle`-word shingles, lower-cased (A-Z). Two documents are linked if
`100 * |A and B| >= percent * |A or B|`; links are confirmed on the full sets of both texts.

1. One pass over the texts gives each document its set size, a 128-bit key of its set, `bands` band hashes of
   `rows` minima each, and the low `BITS` bits of all minima, packed into longs.
2. Documents of equal sets form a class and go on as one row, that of the smallest id.
3. Classes that share a band are candidates. In every bucket each class meets the bucket's centre, the class
   with the most company over all bands, so a bucket gives one pair a member and never all its pairs.
4. Pairs with a centre are confirmed on their texts: the shingles a class has beyond its centre's (`extra`) and those of the
   centre that it lacks (`lack`) are its difference. If x is not linked to the centre and x and y are linked, their differences to
   this centre share elements, and so many that prefixes of both share one, in any fixed order. The order is rare elements first,
   by their number among the classes of the centre, so what a template gives to all its pages stands last; elements of one class
   alone meet nobody and are only counted. So the classes without a link to a centre look for partners among all classes of that
   centre by an equi-join on prefix elements, not by pairs.
5. Prefix elements of more than `HOT` classes are not joined: their classes meet a centre of their own in a further round,
   with differences worked out from those that are known, so no text is read again and a round gives one pair a class and
   element; smaller groups give at most `HOT` / 2 pairs an entry, whatever the size of the table. Groups in which all classes are of one component already are dropped. After `ROUNDS` rounds what is
   left is joined as it is, so nothing is left out.
6. For the pairs of the joins the similarity is first estimated from the packed bits, corrected for chance collisions; those more
   than `DEVIATIONS` standard deviations under the threshold are dropped: by the binomial tail over 96 entries a pair at 0.85 with
   probability 2e-12, at 0.80 with 2e-13, far below the miss of the bands. The others are confirmed on their full sets,
   which the differences to a common centre give: |x and y| = |centre| - |lack of x or y| + |extra of x and y|.

With 24 bands of 4 rows a pair shares no band with probability 2e-8 at similarity 0.85, and 3e-6 at 0.80.

Defined cases: NULL texts and texts without words have empty sets and are linked with nothing. Rows with a NULL id
are linked with nothing, have a NULL component and are kept. Rows of one id that have words count as one document.
Other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import GOLDEN, NOT_BLANK, Words, blocks, mix, row_ranges, stream, text_bytes, words_of
from corpusloom.llm.components import components
from corpusloom.llm.store import cut

BITS = 4
DEVIATIONS = 8
HOT = 2048
ROUNDS = 12
_PER_LONG = 64 // BITS
_EVERY = int("1" * _PER_LONG, 16)


@dataclass(frozen=True)
class NearOptions:
    shingle: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 4

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        share = self.percent / 100
        return share - DEVIATIONS * (share * (1 - share) / self.hashes) ** 0.5 / (1 - 2**-BITS)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a block and the row of each, by row; a shorter text is one shingle."""
    hashes, start = words.ngrams(size)
    found, rows = [hashes], [words.doc[start]]
    n = np.diff(words.first)
    for short in sorted(set(n[(n > 0) & (n < size)].tolist())):
        hashes, start = words.ngrams(short)
        own = n[words.doc[start]] == short
        found.append(hashes[own])
        rows.append(words.doc[start][own])
    hashes, rows = np.concatenate(found), np.concatenate(rows)
    if len(found) > 1:
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indices of one of each (row, hash)."""
    keys = mix(hashes + (rows.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    return np.unique(keys, return_index=True)[1]


def _signatures(words: Words, options: NearOptions):
    """Set sizes, set keys, band hashes and packed bits of a block; zeros for rows without words."""
    hashes, rows = shingles(words, options.shingle)
    own = _distinct(hashes, rows)
    size = np.bincount(rows[own], minlength=words.rows)
    key = np.zeros((words.rows, 2), np.uint64)
    for side, salt in enumerate(stream(7, 2)):
        np.add.at(key[:, side], rows[own], mix(hashes[own] ^ salt))
    filled = np.flatnonzero(size)
    opens = np.searchsorted(rows, filled)
    least = np.zeros((words.rows, options.hashes), np.uint64)
    salts, odd = stream(8, options.hashes), stream(9, options.hashes) | np.uint64(1)
    for j in range(options.hashes if len(filled) else 0):
        least[filled, j] = np.minimum.reduceat((hashes ^ salts[j]) * odd[j], opens)
    least = mix(least)
    band = np.tile(np.arange(1, options.bands + 1, dtype=np.uint64) * GOLDEN, (words.rows, 1))
    for j in range(options.rows):
        band = mix(band ^ least[:, j :: options.rows])
    low = least & np.uint64(2**BITS - 1)
    low = np.pad(low, ((0, 0), (0, -options.hashes % _PER_LONG))).reshape(words.rows, -1, _PER_LONG)
    packed = np.bitwise_or.reduce(low << (np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=2)
    return size, key, band, packed


def _lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * width), flat)


def _signed(docs: DataFrame, options: NearOptions) -> DataFrame:
    """docs: doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in blocks(batch["text"], NOT_BLANK, lower=True):
                size, key, band, packed = _signatures(words, options)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo),
                        pa.array(size.astype(np.int64)),
                        pa.array([k.tobytes() for k in key], pa.binary()),
                        _lists(band),
                        _lists(packed),
                    ],
                    names=["doc_id", "n", "set", "bands", "bits"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n bigint, set binary, bands array<bigint>, bits array<bigint>")


def estimate(a: Column, b: Column, hashes: int) -> Column:
    """Similarity from packed low bits: the share of equal entries, less those equal by chance."""
    longs = -(-hashes // _PER_LONG)

    def unequal(k: int) -> Column:
        differ = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        folded = reduce(lambda x, y: x.bitwiseOR(y), [F.shiftrightunsigned(differ, s) for s in range(BITS)])
        return F.bit_count(folded.bitwiseAND(F.lit(_EVERY)))

    equal = F.lit(hashes) - reduce(lambda x, y: x + y, [unequal(k) for k in range(longs)])
    chance = 2.0**-BITS
    return (equal / F.lit(hashes) - chance) / (1 - chance)


def _near_enough(a: str, b: str, options: NearOptions) -> Column:
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(n_a, n_b) >= options.percent * F.greatest(n_a, n_b)
    return sizes & (estimate(F.col(f"{a}.bits"), F.col(f"{b}.bits"), options.hashes) >= options.least_estimate)


def _compared(left: pa.Array, right: pa.Array, options: NearOptions):
    """Per pair of a text and its centre: linked on full sets; the hashes of the text's shingles that the centre lacks and of the
    centre's that the text lacks, each with its numbers per pair; the sizes of both sets."""
    sides = [text_bytes(left), text_bytes(right)]
    linked, sizes = [np.zeros(0, bool)], [np.zeros((2, 0), np.int64)]
    apart: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
    numbers: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    for lo, hi in row_ranges(sides[0][1] + sides[1][1]):
        hashes, rows, side = [], [], []
        for number, (data, at) in enumerate(sides):
            words = words_of(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], NOT_BLANK, lower=True)
            own, row = shingles(words, options.shingle)
            once = _distinct(own, row)
            hashes.append(own[once])
            rows.append(row[once])
            side.append(np.full(len(once), number))
        hashes, rows, side = (np.concatenate(x) for x in (hashes, rows, side))
        keys = mix(hashes + (rows.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        order = np.argsort(keys)
        equal = keys[order][1:] == keys[order][:-1]
        n, pairs = hi - lo, rows[order[1:][equal]]
        both = np.bincount(pairs, minlength=n)
        n_own, n_centre = (np.bincount(rows[side == k], minlength=n) for k in (0, 1))
        linked.append(100 * both >= options.percent * (n_own + n_centre - both))
        sizes.append(np.stack([n_own, n_centre]))
        alone = np.ones(len(order), bool)
        alone[1:][equal] = False
        alone[:-1][equal] = False
        alone = order[alone]
        for k in (0, 1):
            of_side = alone[side[alone] == k]
            of_side = of_side[np.argsort(rows[of_side], kind="stable")]
            apart[k].append(hashes[of_side])
            numbers[k].append(np.bincount(rows[of_side], minlength=n))
    n_own, n_centre = np.concatenate(sizes, axis=1)
    both_sides = [(np.concatenate(apart[k]), np.concatenate(numbers[k])) for k in (0, 1)]
    return np.concatenate(linked), both_sides, n_own, n_centre


_STARS = ["centre", "rep", "linked", "extra", "lack", "n_own", "n_centre"]


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, options: NearOptions) -> DataFrame:
    """pairs: a, b (ids). Classes with their centre: centre, rep, linked, extra, lack, n_own, n_centre."""
    needed = cut(
        pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(
            classes.select(F.col("rep").alias("doc_id"), "set"), "doc_id"
        ),
        "needed",
    )

    def own_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for lo, hi, words in blocks(batch["text"], NOT_BLANK, lower=True):
                hashes, rows = shingles(words, options.shingle)
                own = _distinct(hashes, rows)
                key = np.zeros((words.rows, 2), np.uint64)
                for side, salt in enumerate(stream(7, 2)):
                    np.add.at(key[:, side], rows[own], mix(hashes[own] ^ salt))
                keep += [k.tobytes() == want for k, want in zip(key, batch["set"][lo:hi].to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["doc_id", "text"])

    # An id with several rows brings only the text of its class. The hint keeps one plan at every size.
    texts = docs.join(needed.hint("merge"), "doc_id").mapInArrow(own_set, "doc_id bigint, text string")
    texts = cut(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, apart, n_own, n_centre = _compared(batch["a_text"], batch["b_text"], options)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(found.view(np.int64))
                )
                for found, n in apart
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["b"], batch["a"], pa.array(linked), *lists, pa.array(n_own), pa.array(n_centre)], names=_STARS
            )

    sides = [texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"{s}_text")) for s in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "a_text", "b_text").mapInArrow(
        check,
        "centre bigint, rep bigint, linked boolean, extra array<bigint>, lack array<bigint>, n_own bigint, n_centre bigint",
    )


def _star_pairs(members: DataFrame) -> DataFrame:
    """members: bucket, rep, company. Every class (a) with the centre (b) of each of its buckets."""
    centres = members.groupBy("bucket").agg(F.min_by("rep", F.struct(-F.col("company"), F.col("rep"))).alias("b"))
    return members.join(centres, "bucket").filter("rep != b").select(F.col("rep").alias("a"), "b").distinct()


def _filtered(pairs: DataFrame, classes: DataFrame, options: NearOptions) -> DataFrame:
    known = classes.select("rep", F.struct("n", "bits").alias("own"))
    sides = [known.select(F.col("rep").alias(s), F.col("own").alias(f"own_{s}")) for s in ("a", "b")]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return joined.filter(_near_enough("own_a", "own_b", options)).select("centre", "a", "b")


def _whole_division(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("bigint")


def _prefix_length(n: Column, partner: Column, most: Column) -> Column:
    """How much of a difference of `n` elements meets that of a linked class of at least `partner` elements.

    A linked pair differs in `most` elements at most, so the differences share (n + partner - most) / 2 of them or more, and one at
    least. Sets that share `shared` elements share one in prefixes of n - shared + 1.
    """
    shared = F.greatest(F.lit(1), F.ceil((n + partner - most) / 2))
    return F.greatest(n - shared + 1, F.lit(0)).cast("bigint")


def _entries(stars: DataFrame, options: NearOptions) -> DataFrame:
    """Prefix elements of all classes of centres that not all of them are linked to: centre, rep, linked, n_open, n_differ,
    n_own, place, element. `n_open` is the prefix that is needed to meet classes without a link."""
    open_centres = stars.filter("not linked").select("centre").distinct()
    stars = stars.join(open_centres, "centre", "left_semi")
    # The two sides of a difference are told apart by flipping all bits of one.
    element = F.concat("extra", F.transform("lack", lambda h: F.bitwise_not(h)))
    elements = stars.select("centre", "rep", F.explode(element).alias("element"))
    common = elements.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    by_rarity = F.sort_array(F.collect_list(F.struct("holders", "element")))
    listed = elements.join(common, ["centre", "element"]).groupBy("centre", "rep").agg(by_rarity.alias("common"))
    n, own = F.col("n_differ"), F.col("n_own")
    most = _whole_division((100 - options.percent) * _whole_division(100 * own, options.percent), 100)
    # More than so many elements lie between the centre and a class without a link to it.
    apart = _whole_division((100 - options.percent) * F.col("n_centre"), 100) + 1
    to_open = _prefix_length(n, F.greatest(n - most, apart), most)
    full = F.when(F.col("linked"), to_open).otherwise(_prefix_length(n, F.greatest(n - most, F.lit(0)), most))
    known = stars.select(
        "centre", "rep", "linked", "n_own", "n_centre", (F.size("extra") + F.size("lack")).cast("bigint").alias("n_differ")
    ).join(listed, ["centre", "rep"])
    # Elements that no other class holds come first and are only counted.
    alone = n - F.size("common")
    held = F.slice("common", F.lit(1), F.greatest(full - alone, F.lit(0)).cast("int"))
    return known.select(
        "centre", "rep", "linked", to_open.alias("n_open"), "n_differ", "n_own", alone.alias("alone"), F.posexplode(held).alias("at", "held")
    ).select(
        "centre", "rep", "linked", "n_open", "n_differ", "n_own", (F.col("alone") + F.col("at")).alias("place"),
        F.col("held.element").alias("element"),
    )


def _meeting(entries: DataFrame, options: NearOptions) -> DataFrame:
    """Pairs of classes (centre, a, b), one without a link to the centre, that share an element of their prefixes."""
    own = entries.filter("not linked").alias("x")
    one, other = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    both_open = (other("place") < other("n_open")) & (one("place") < one("n_open")) & (one("rep") < other("rep"))
    # At the first element they share, both must have enough left to share what a linked pair of these sizes does.
    most = F.floor((100 - options.percent) * (one("n_own") + other("n_own")) / (100 + options.percent))
    shared = F.ceil((one("n_differ") + other("n_differ") - most) / 2)
    enough = F.least(one("n_differ") - one("place"), other("n_differ") - other("place")) >= shared
    meets = (
        (one("centre") == other("centre")) & (one("element") == other("element")) & (one("rep") != other("rep"))
        & (other("linked") | both_open) & enough
    )
    a, b = F.greatest(one("rep"), other("rep")), F.least(one("rep"), other("rep"))
    pairs = own.join(entries.alias("y"), meets).select(one("centre").alias("centre"), a.alias("a"), b.alias("b"))
    return pairs.groupBy("a", "b").agg(F.min("centre").alias("centre"))


def _both_sides(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """pairs: centre, a, b. Adds the differences of both to the centre as structs x and y."""
    own = F.struct("extra", "lack", "n_own", "n_centre")
    sides = [stars.select("centre", F.col("rep").alias(s), own.alias(name)) for s, name in (("a", "x"), ("b", "y"))]
    return pairs.join(sides[0], ["centre", "a"]).join(sides[1], ["centre", "b"])


def _linked(both: Column, n_a: Column, n_b: Column, options: NearOptions) -> Column:
    return 100 * both >= options.percent * (n_a + n_b - both)


def _recentred(pairs: DataFrame, stars: DataFrame, options: NearOptions) -> DataFrame:
    """pairs: centre, a, b. The classes a with b as their centre, from the differences of both to the centre they had."""
    found = _both_sides(pairs, stars).select(
        F.col("b").alias("centre"),
        F.col("a").alias("rep"),
        F.array_union(F.array_except("y.lack", "x.lack"), F.array_except("x.extra", "y.extra")).alias("extra"),
        F.array_union(F.array_except("x.lack", "y.lack"), F.array_except("y.extra", "x.extra")).alias("lack"),
        F.col("x.n_own").alias("n_own"),
        F.col("y.n_own").alias("n_centre"),
    )
    both = F.col("n_own") - F.size("extra")
    return found.withColumn("linked", _linked(both, F.col("n_own"), F.col("n_centre"), options)).select(*_STARS)


def _confirmed_by_differences(pairs: DataFrame, stars: DataFrame, options: NearOptions) -> DataFrame:
    """The pairs (centre, a, b) that are linked on their full sets, as a, b."""
    without = F.size("x.lack") + F.size("y.lack") - F.size(F.array_intersect("x.lack", "y.lack"))
    both = F.col("x.n_centre") - without + F.size(F.array_intersect("x.extra", "y.extra"))
    return _both_sides(pairs, stars).filter(_linked(both, F.col("x.n_own"), F.col("y.n_own"), options)).select("a", "b")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose sides are of different components."""
    for side in ("a", "b"):
        of_side = found.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}"))
        pairs = pairs.join(of_side, side, "left").withColumn(f"in_{side}", F.coalesce(f"in_{side}", side))
    return pairs.filter("in_a != in_b").select("centre", "a", "b")


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components `found` (node, component) with further links a, b: only components that these join are worked out anew."""
    for side in ("a", "b"):
        of_side = found.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}"))
        links = links.join(of_side, side, "left").withColumn(f"in_{side}", F.coalesce(f"in_{side}", side))
    joins = cut(links.filter("in_a != in_b").select(F.col("in_a").alias("a"), F.col("in_b").alias("b")).distinct(), "joins")
    if joins.isEmpty():
        return found
    of_components = components(joins)
    moved = of_components.select(F.col("node").alias("component"), F.col("component").alias("moved"))
    whole = found.join(moved, "component", "left").select("node", F.coalesce("moved", "component").alias("component"))
    return cut(whole.unionByName(of_components), "found")


def _with_rest(
    found: DataFrame, stars: DataFrame, classes: DataFrame, options: NearOptions, hot: int = HOT, rounds: int = ROUNDS
) -> DataFrame:
    """The components `found` of the star links, with the links between their classes that are none of a star."""
    for turn in range(rounds + 1):
        if stars.filter("not linked").isEmpty():
            break
        entries = cut(_entries(stars, options), "entries")
        own = found.select(F.col("node").alias("rep"), F.col("component").alias("own_component"))
        within = entries.join(own, "rep", "left").withColumn("own_component", F.coalesce("own_component", "rep"))
        groups = within.groupBy("centre", "element").agg(
            F.count(F.lit(1)).alias("size"), F.max(~F.col("linked")).alias("open"),
            F.min("own_component").alias("least"), F.max("own_component").alias("greatest"),
        )
        groups = cut(groups.filter("size > 1 and open and least != greatest").select("centre", "element", "size"), "groups")
        is_hot = F.col("size") > (hot if turn < rounds else 1 << 62)
        small = entries.join(groups.filter(~is_hot), ["centre", "element"])
        near = _filtered(_apart(_meeting(small, options), found), classes, options)
        found = _merged(found, _confirmed_by_differences(near, stars, options))
        large = groups.filter(is_hot)
        if large.isEmpty():
            break
        members = entries.join(large, ["centre", "element"]).withColumn("bucket", F.struct("centre", "element"))
        company = members.groupBy("rep").agg(F.sum("size").alias("company"))
        centres = members.join(company, "rep").groupBy("bucket").agg(
            F.min_by("rep", F.struct(-F.col("company"), F.col("rep"))).alias("b")
        )
        pairs = members.join(centres, "bucket").filter("rep != b").groupBy(F.col("rep").alias("a"), "b")
        stars = cut(_recentred(pairs.agg(F.min("centre").alias("centre")), stars, options), "stars")
        found = _merged(found, stars.filter("linked").select(F.col("rep").alias("a"), F.col("centre").alias("b")))
    return found


def _same_id(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that have one id and different sets."""
    rows = signed.filter("n > 0 and doc_id is not null").select("doc_id", "set")
    apart = rows.groupBy("doc_id").agg(F.min("set").alias("one"), F.max("set").alias("other")).filter("one != other")
    held = rows.join(apart.select("doc_id"), "doc_id").distinct().join(classes.select("set", "rep"), "set")
    least = held.groupBy("doc_id").agg(F.min("rep").alias("b"))
    return held.join(least, "doc_id").select(F.col("rep").alias("a"), "b").filter("a != b")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", options: NearOptions = NearOptions()
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `df`."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = cut(_signed(docs, options), "signed")
    classes = cut(
        signed.filter("n > 0 and doc_id is not null")
        .groupBy("set")
        .agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "bands", "bits")]),
        "classes",
    )
    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut(entries.join(shared, "bucket"), "members")
    company = members.groupBy("rep").agg(F.sum("size").alias("company"))
    stars = cut(_confirmed(cut(_star_pairs(members.join(company, "rep")), "pairs"), classes, docs, options), "stars")
    links = stars.filter("linked").select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    linked = _with_rest(components(links.unionByName(_same_id(signed, classes))), stars, classes, options)
    grouped = classes.select("set", "rep").join(linked, F.col("rep") == F.col("node"), "left")
    grouped = grouped.select("set", F.coalesce("component", "rep").alias("found"))
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"), "set")
        .join(grouped, "set", "left")
        .select("doc_id", "n_shingles", found.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", **named) -> DataFrame:
    """The rows of `df` that are kept: of each group of near-duplicates the document of the smallest id."""
    gone = cut(near_duplicates(df, doc_id, **named).filter("not kept").select(F.col("doc_id").alias("_gone")), "gone")
    return df.join(gone.distinct(), F.col(doc_id) == F.col("_gone"), "left_anti")
