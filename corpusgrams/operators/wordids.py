"""Word ids that stay when the vocabulary grows.

A dense id in word order changes with every new word.  Here an id is a hash of
the word: the same in every corpus, whatever else it holds.  Two words of one
hash would share an id, so ids are given in rounds: in round ``salt`` each word
still without an id proposes the hash of ``salt`` and itself; a proposal that an
earlier word holds is refused, of several new words the first in word order gets
it, the others go on.  ``known`` ids (of an earlier, smaller corpus) are held
from the start, so a second corpus never moves a word of the first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BITS = 60  # a million words meet with a probability of about 5e-7
ROUNDS = 64


def proposed_id(word: Column, salt: int, bits: int = BITS) -> Column:
    """The first 15 hex digits of the md5 of the word (and the salt, from the second
    round on) as a number of ``bits`` bits."""
    text = word if salt == 0 else F.concat(F.lit(f"{salt}:"), word)
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), 60 - bits)


def stable_word_ids(words: DataFrame, known: DataFrame | None = None, bits: int = BITS) -> DataFrame:
    """word, word_id of every distinct word (column ``word``) of ``words`` and every
    row of ``known`` (word, word_id: what this function gave before).

    Null words have no id.  ``word_id`` is unique; a word of ``known`` keeps its
    own.  Later rounds hold only words that met, for 60 bits practically none."""
    left = words.select("word").filter("word IS NOT NULL").distinct()
    given: list[DataFrame] = []
    if known is not None:
        given.append(known.select("word", "word_id"))
        left = left.join(given[0].select("word"), "word", "left_anti")
    for salt in range(ROUNDS):
        asked = left.withColumn("word_id", proposed_id(F.col("word"), salt, bits))
        if given:
            held = reduce(DataFrame.unionByName, given).select("word_id")
            free = asked.join(held, "word_id", "left_anti")
        else:
            free = asked
        won = cut_lineage(free.groupBy("word_id").agg(F.min("word").alias("word")).select("word", "word_id"))
        given.append(won)
        left = cut_lineage(left.join(won, "word", "left_anti"))
        if not left.take(1):
            return reduce(DataFrame.unionByName, given)
    raise ValueError(f"{bits} bits are too few for these words")
