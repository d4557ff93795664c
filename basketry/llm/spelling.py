"""Spelling variants of a vocabulary, by words over a reduced alphabet.

1. Every letter is hashed to one of a few symbols, so that each word becomes a
   reduced word. Words one edit apart have reduced words at most one edit apart.
2. Each word brings the reduced words one edit away from its own, by deletion,
   replacement and insertion, and its own, and meets the words that have them.
   An insertion into one word is a deletion from the other, and a replacement by
   a greater symbol one by a smaller, so each pair is made from one side only.
3. The original strings are compared.

The number of symbols comes from the size of the vocabulary: with s symbols
there are s^10 reduced words of a common length, so that it takes about V^(1/10)
of them to keep words apart on average, however many there are. Fewer symbols
make fewer neighbours and more strings to compare. The number moves work only;
results are the same with any.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from basketry.session import materialize

#: Least number of code points and of occurrences of a word.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times as frequent a word's form is.
TIMES = 10
#: One run in so many loses a code point.
DAMAGED = 31
#: Words whose neighbourhoods one task makes, on average.
WORDS_A_TASK = 20_000

LETTERS = r"A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def occurrences(docs: DataFrame) -> DataFrame:
    """Every kept occurrence of a word in ``docs``, as column ``word``.

    Takes doc_id and text. Runs of letters shorter than the shortest word are
    left out as they are read; damage only makes them shorter.
    """
    runs = F.regexp_extract_all("text", F.lit(f"(?<![{LETTERS}])[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    run = docs.select(F.col("doc_id").cast("string").alias("key"), F.explode(runs).alias("run"))
    # lower() also folds letters beyond Z, so it serves only where it changes nothing
    run = run.withColumn(
        "run", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    )
    hashed = F.coalesce(F.crc32(F.concat("key", F.lit(":"), "run")), F.lit(1))
    at = (F.col("hashed") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.lit(1 << 30)))
    word = F.when(F.col("hashed") % DAMAGED == 0, cut).otherwise(F.col("run"))
    return run.withColumn("hashed", hashed).select(word.alias("word"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """The words (word, n) of whole texts, counted over all documents."""
    found = occurrences(docs).where(F.char_length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def symbols_for(n_words: int, length: int = 10) -> int:
    """How many symbols keep most reduced words of a common length apart."""
    return max(4, min(len(_SYMBOLS), math.ceil(max(n_words, 1) ** (1 / length)) + 1))


def symbol(letter: str, symbols: int) -> str:
    """The symbol that a letter is hashed to."""
    return _SYMBOLS[(ord(letter) * 2654435761 % 2**32 >> 16) % symbols]


def reduced(word: Column, symbols: int) -> Column:
    letters = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))
    return F.translate(word, letters, "".join(symbol(x, symbols) for x in letters))


def neighbourhood(word: Column, symbols: int) -> Column:
    """A reduced word, its deletions, and its replacements by smaller symbols."""
    ahead = lambda i: F.substring(word, F.lit(1), i - 1)
    behind = lambda i: F.substring(word, i + 1, F.lit(1 << 30))
    here = lambda i: F.substring(word, i, F.lit(1))
    places = F.sequence(F.lit(1), F.char_length(word))
    every = F.array(*map(F.lit, _SYMBOLS[:symbols]))
    deleted = F.transform(places, lambda i: F.concat(ahead(i), behind(i)))
    replaced = F.flatten(
        F.transform(
            places,
            lambda i: F.transform(
                F.filter(every, lambda s: s < here(i)), lambda s: F.concat(ahead(i), s, behind(i))
            ),
        )
    )
    return F.array_distinct(F.concat(F.array(word), deleted, replaced))


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """All pairs of ``words`` (word, n) one edit apart, once each: a, a_n, b, b_n.

    ``words`` has distinct words; write it first, as it is read three times.
    """
    n_words = words.count()
    symbols = symbols or symbols_for(n_words)
    short = words.select("word", "n", reduced(F.col("word"), symbols).alias("reduced"))
    # each word becomes some dozens of rows, so tasks take few words
    dealt = short.repartition(max(1, math.ceil(n_words / WORDS_A_TASK)), "word")
    near = F.posexplode(neighbourhood(F.col("reduced"), symbols)).alias("place", "near")
    keys = dealt.select(F.col("word").alias("a"), F.col("n").alias("a_n"), near).select(
        "a", "a_n", (F.col("place") == 0).alias("same"), F.xxhash64("near").alias("key")
    )
    own = short.select(
        F.xxhash64("reduced").alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n")
    )
    # words of one reduced word meet from both sides
    once = ~F.col("same") | (F.col("a") < F.col("b"))
    near_enough = once & (F.levenshtein("a", "b", 1) == 1)
    return keys.join(own, "key").where(near_enough).select("a", "a_n", "b", "b_n")


def _roots(forms: DataFrame) -> DataFrame:
    """The end of each word's forms, for every word that has one.

    Joins words with the form of what they have reached, which doubles the steps
    taken each round. A form is ``TIMES`` times as frequent as its word, so that
    a chain has at most about 19 steps and the rounds are at most six.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(
            reached.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, symbols: int | None = None) -> DataFrame:
    """Words of ``docs`` with their frequent variant: word, form, root, n, n_near, form_n.

    A word is a run of letters, A-Z lower-cased, of at least 7 code points that
    occurs at least twice. Where 31 divides the crc32 of ``<doc_id>:<run>``, the
    run first loses one code point. Two words are near if one insertion, deletion
    or replacement parts them. The form is the near word of largest n (ties: the
    smallest), if it is 10 times as frequent, else null; root follows forms to the
    last, or is the word itself.

    A null text has no words; a run of a row without doc_id loses nothing; rows
    that repeat count each; other columns are left out; an empty table gives no
    words. Runs jobs: the vocabulary, the pairs and the roots' rounds are written.
    """
    words = materialize(vocabulary(docs))
    pairs = materialize(near_words(words, symbols))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    named = materialize(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
