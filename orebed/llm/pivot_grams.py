"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered from rare to frequent. A word's prefix is its three rarest bigrams (with
all places where the third one occurs), and two disjoint ones of these are its pivots, chosen
by dynamic programming for the smallest total frequency. One edit spoils at most one of two
disjoint bigrams, so of two words one edit apart, the one whose prefix ends with the rarer
bigram has a pivot in the other's prefix. The place of the edit limits where it can be: behind
the first pivot, and then both words are equal up to its end, or before the second, and then
they are equal from its start on; the same reasoning leaves one half of what remains equal.
Pivots therefore meet prefixes in one equality join on (side, half, length, equal letters),
and pairs are verified by their edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import columns_of
from orebed.session import durable

#: The letters of a word, and those that are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bigrams of a prefix: length of a bigram times one edit, plus one.
PREFIX = 3


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """The run without one letter where `every` divides its checksum with the document's id."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """Words of at least `shortest` letters with `least` occurrences or more: word, n."""
    # Shorter runs cannot give words; the greedy pattern takes longer ones whole.
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    each = columns_of(docs, doc_id="string", text="string").select("doc_id", F.explode(runs).alias("run"))
    each = each.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = each.select(damaged(F.col("run"), F.col("doc_id"), every).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= least) & (F.char_length("word") >= shortest))


def pivots_of(prefix: list[tuple[int, int]], weights: list[int]) -> list[tuple[int, int]]:
    """Of (place, rank) pairs in order of places, the two disjoint ones of least total weight.

    one[i] is the lightest bigram among the first i + 1, pair[i] the lightest disjoint pair:
    bigram i joins the lightest one that ends before it, or the best pair so far stays.
    """
    one: list[tuple[int, int]] = []
    pair: tuple[int, int, int] | None = None
    for i, (place, rank) in enumerate(prefix):
        before = next((k for k in (i - 1, i - 2) if k >= 0 and prefix[k][0] <= place - 2), None)
        if before is not None:
            cost, k = one[before]
            pair = min(filter(None, (pair, (cost + weights[rank], k, i))))
        one.append(min((weights[rank], i), one[-1]) if one else (weights[rank], i))
    return [prefix[k] for k in pair[1:]]


def prefix_of(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """(place, rank) of a word's rarest bigrams, by place; all places of the last one count."""
    grams = [ranks[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(grams)[PREFIX - 1]
    return [(i, g) for i, g in enumerate(grams) if g <= last]


def keys_of(word: str, place: int, sides: tuple[bool, ...], sizes: tuple[int, ...]) -> Iterator[int]:
    """What this word and one of a given size, one edit away beyond the bigram at `place`, share.

    On the side of the start, both have the letters up to the bigram's end; what comes after
    them in the other word has two halves, one of which is whole in this word too. On the side
    of the end, likewise. A key is a hash of side, half, size and the shared letters.
    """
    for start in sides:
        known, gap = (word[: place + 2], word[place + 2 :]) if start else (word[place:], word[:place])
        for size in sizes:
            rest = size - len(known)
            if rest < 0:
                continue
            half, other = rest // 2, rest - rest // 2
            if len(gap) >= half:
                yield _hash(f"{start:d}0{size}\n{known}\n{gap[:half]}")
            if len(gap) >= other:
                yield _hash(f"{start:d}1{size}\n{known}\n{gap[len(gap) - other :]}")


def _hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


def _index(grams: list[str], weights: list[int]):
    ranks = {g: i for i, g in enumerate(grams)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                prefix, size = prefix_of(word, ranks), len(word)
                last = max(g for _, g in prefix)
                keys = [(False, k) for place, _ in prefix for k in keys_of(word, place, (True, False), (size,))]
                (first, _), (second, _) = pivots_of(prefix, weights)
                near = (size - 1, size, size + 1)
                keys += [(True, k) for k in keys_of(word, first, (True,), near)]
                keys += [(True, k) for k in keys_of(word, second, (False,), near)]
                rows += [(pivot, k, last, word, n) for pivot, k in keys]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pivot", "key", "last", "word", "n"]
            )

    return run


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of words (word, n) that differ by one letter, each once: a, n_a, b, n_b with a < b.

    Words have four bigrams at least, that is, five letters.
    """
    size = F.char_length("word")
    grams = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    # At most (26 + 64) ** 2 bigrams of such letters exist: the bound of what is collected and shipped.
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    order = counted.orderBy("n", "gram").collect()
    kind = "pivot boolean, key long, last int, word string, n long"
    index = durable(words.mapInArrow(_index([r[0] for r in order], [r[1] for r in order]), kind))
    pivots = index.where("pivot").select("key", F.col("last").alias("last_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    prefixes = index.where("not pivot").select("key", F.col("last").alias("last_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = pivots.join(prefixes, "key").where("last_a <= last_b and a != b")
    near = met.where(F.levenshtein("a", "b", 1) == 1)
    left, right = F.struct(F.col("a"), F.col("n_a")), F.struct(F.col("b").alias("a"), F.col("n_b").alias("n_a"))
    sides = near.select(F.least(left, right).alias("l"), F.greatest(left, right).alias("r")).distinct()
    return sides.select(F.col("l.a").alias("a"), F.col("l.n_a").alias("n_a"), F.col("r.a").alias("b"), F.col("r.n_a").alias("n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """The end of every chain of (word, form): word, root.

    A form is at least twice as frequent as its word, so a chain has at most 63 steps; each
    round doubles the steps taken.
    """
    at = durable(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("changed")))
    while not at.where("changed").isEmpty():
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = at.join(further, "root", "left")
        at = durable(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("changed")))
    return at.select("word", "root")


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """One row per word of a table (word, n): word, form, root, n, n_near, form_n.

    n_near counts the words one edit away. The most frequent of them (of equally frequent ones
    the smallest by code points) is the word's form if it is `times` as frequent as the word, else
    null; root follows forms to the last, and is the word itself where there is none.
    """
    words = durable(words)
    pairs = near_words(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )).alias("x")).select("x.*")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    found = both.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    often = -F.col("best.less") >= times * F.col("n")
    found = durable(
        found.select(
            "word", "n", "n_near", F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")
        )
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """Words of all documents with their variants: word, form, root, n, n_near, form_n.

    Null and empty texts have no words, a null doc_id counts as an empty one in the checksum.
    Repeated rows count as often as they are there; other columns are left out; an empty table
    gives an empty table. Whole texts are read, however long they or their words are.
    """
    return variants(word_counts(docs))
