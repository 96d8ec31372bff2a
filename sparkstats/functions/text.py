"""Text functions as column expressions."""

from pyspark.sql import Column, functions as F

# Letters with diacritics and the letters they become.
LETTERS_DIA = "áčďéěíňóřšťúůýž"
LETTERS_NODIA = "acdeeinorstuuyz"

# The characters at which whitespace tokenising splits.
WHITESPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
WORD = r"[\p{L}\p{N}_]+"
LONG_WORD = r"[\p{L}\p{N}_]{2,}"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def strip_diacritics(text, letters: str = LETTERS_DIA, plain: str = LETTERS_NODIA) -> Column:
    """Replace each letter, in both cases, by its plain form."""
    return F.translate(_col(text), letters + letters.upper(), plain + plain.upper())


def tokens(text) -> Column:
    """Maximal runs of Unicode word characters."""
    return F.regexp_extract_all(_col(text), F.lit(f"({WORD})"), F.lit(1))


def long_tokens(text) -> Column:
    """Word tokens of at least two characters."""
    return F.regexp_extract_all(_col(text), F.lit(f"({LONG_WORD})"), F.lit(1))


def words(text) -> Column:
    """Pieces between runs of whitespace; empty pieces do not count."""
    return F.filter(F.split(_col(text), WHITESPACE), lambda w: w != "")


def _starts(size: Column, n: int) -> Column:
    """0 .. size - n, or nothing when size < n."""
    return F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))


def word_ngrams(toks, n: int) -> Column:
    """Space-joined runs of n neighbouring tokens."""
    toks = _col(toks)
    if n == 1:
        return toks
    return F.transform(_starts(F.size(toks), n), lambda i: F.concat_ws(" ", *[F.get(toks, i + j) for j in range(n)]))


def char_ngrams(word, n: int) -> Column:
    """Character n-grams of one word padded by a space on each side.

    A padded word shorter than n has none.
    """
    padded = F.concat(F.lit(" "), _col(word), F.lit(" "))
    return F.transform(_starts(F.length(padded), n), lambda i: F.substring(padded, i + 1, F.lit(n)))
