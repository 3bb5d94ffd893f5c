"""Topic patterns: words separated by dots, ``*`` for one word, ``#`` for any
number of words."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pattern words at either end that take part in the index key.
INDEXED_WORDS = 4

#: Mask of patterns that are filed under a word that may stand anywhere.
ANYWHERE = 1 << (2 * INDEXED_WORDS)


def words(key: Column) -> Column:
    """Words of a routing key; the empty key has none."""
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.split(key, r"\."))


def topic_regex(pattern: Column) -> Column:
    """Regular expression that a routing key with a dot appended must match."""
    one = F.transform(
        words(pattern),
        lambda w: F.when(w == "*", r"[^.]*\.")
        .when(w == "#", r"([^.]*\.)*")
        .otherwise(F.concat(F.lit(r"\Q"), w, F.lit(r"\E\."))),
    )
    return F.concat(F.lit("^"), F.array_join(one, ""), F.lit("$"))


def topic_matches(pattern: Column, key: Column) -> Column:
    """True if ``key`` matches ``pattern``."""
    dotted = F.when(key == "", F.lit("")).otherwise(F.concat(key, F.lit(".")))
    return F.regexp(dotted, topic_regex(pattern))


def index_mask(pattern: Column) -> Column:
    """Which words a key must share with the pattern, as a bit mask: the literal
    ones of the first words before any ``#``, else those of the last words after
    any ``#``, counted from the end, else (``ANYWHERE``) its first literal word at
    any place.  Only patterns of nothing but wildcards have none."""

    def mask(fixed: Column, shift: int) -> Column:
        return reduce(add, [F.when(_literal(fixed, i), 1 << (shift + i)).otherwise(0) for i in range(INDEXED_WORDS)])

    first, last = mask(_fixed_words(pattern), 0), mask(_last_words(pattern), INDEXED_WORDS)
    anywhere = F.when(_first_literal(words(pattern)).isNotNull(), ANYWHERE).otherwise(0)
    return F.when(first > 0, first).when(last > 0, last).otherwise(anywhere)


def _fixed_words(pattern: Column) -> Column:
    """Words before the first ``#``."""
    all_words = words(pattern)
    hash_at = F.array_position(all_words, "#")
    return F.when(hash_at > 0, F.slice(all_words, F.lit(1), (hash_at - 1).cast("int"))).otherwise(
        all_words
    )


def _last_words(pattern: Column) -> Column:
    """Words after the last ``#``, the last one first."""
    turned = F.reverse(words(pattern))
    hash_at = F.array_position(turned, "#")
    return F.when(hash_at > 0, F.slice(turned, F.lit(1), (hash_at - 1).cast("int"))).otherwise(turned)


def _first_literal(all_words: Column) -> Column:
    return F.get(F.filter(all_words, lambda w: ~w.isin("*", "#")), F.lit(0))


def _literal(fixed: Column, i: int) -> Column:
    word = F.get(fixed, F.lit(i))
    return word.isNotNull() & (word != "*")


def index_key(all_words: Column, mask: Column) -> Column:
    """The words that ``mask`` selects, each followed by a dot; null if one of
    them is missing.  ``mask`` is a column or a literal column."""
    n = F.size(all_words)
    places = [F.lit(i) for i in range(INDEXED_WORDS)] + [n - 1 - i for i in range(INDEXED_WORDS)]
    parts = [
        F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.concat(F.get(all_words, at), F.lit("."))).otherwise("")
        for i, at in enumerate(places)
    ]
    return F.when(mask == ANYWHERE, F.concat(_first_literal(all_words), F.lit("."))).otherwise(F.concat(*parts))


def anywhere_keys(all_words: Column) -> Column:
    """Index keys of a routing key under the mask ``ANYWHERE``."""
    return F.transform(F.array_distinct(all_words), lambda w: F.concat(w, F.lit(".")))


def exact_mask(pattern: Column) -> Column:
    """True if the index key and the number of words decide the match: no ``#``,
    or a single one at an end, and no word beyond the indexed ones."""
    all_words = words(pattern)
    hash_at = F.array_position(all_words, "#")
    n = F.size(all_words)
    single = F.size(F.filter(all_words, lambda w: w == "#")) == 1
    at_end = single & ((hash_at == n) | (hash_at == 1)) & (n <= INDEXED_WORDS + 1)
    return ((hash_at == 0) & (n <= INDEXED_WORDS)) | at_end


def fixed_count(pattern: Column) -> Column:
    """Number of words the key must have; with ``#`` the number it must at least
    have, as ``-1 - n``."""
    all_words = words(pattern)
    n = F.size(all_words)
    hashes = F.size(F.filter(all_words, lambda w: w == "#"))
    return F.when(hashes > 0, F.lit(-1) - (n - hashes)).otherwise(n)


def index_entry(pattern: str) -> tuple[int, str | None, int, str | None]:
    """Mask, index key, number of words and (where these do not decide) regular expression of one
    pattern: what the columns above give, for bindings that are on the driver anyway."""
    every = pattern.split(".") if pattern else []
    n, hashes = len(every), every.count("#")
    literal = lambda w: w not in ("*", "#")
    first = every[: every.index("#")] if hashes else every
    turned = every[::-1]
    last = turned[: turned.index("#")] if hashes else turned
    bits = lambda fixed, shift: sum(1 << (shift + i) for i, w in enumerate(fixed[:INDEXED_WORDS]) if w != "*")
    mask = bits(first, 0) or bits(last, INDEXED_WORDS) or (ANYWHERE if any(map(literal, every)) else 0)
    if mask == ANYWHERE:
        key = next(filter(literal, every)) + "."
    else:
        chosen = [every[i] for i in range(INDEXED_WORDS) if mask >> i & 1] + [turned[i] for i in range(INDEXED_WORDS) if mask >> (INDEXED_WORDS + i) & 1]
        key = "".join(f"{w}." for w in chosen)
    ends = hashes == 1 and (every[0] == "#" or every[-1] == "#") and n <= INDEXED_WORDS + 1
    exact = (not hashes and n <= INDEXED_WORDS) or ends
    pieces = {"*": r"[^.]*\.", "#": r"([^.]*\.)*"}
    regex = None if exact else "^" + "".join(pieces.get(w, rf"\Q{w}\E\.") for w in every) + "$"
    return mask, key, -1 - (n - hashes) if hashes else n, regex
