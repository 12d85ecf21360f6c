"""Text functions as Catalyst expressions (no Python UDFs).

All of them work on the whole text of a row; nothing truncates input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.schemas import CHUNK_TOKEN_LIMIT, FILLER_TOKENS

# Token rule: a run of letters/digits, or one other non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
# A word: a run of letters.
WORD_PATTERN = r"\p{L}+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.
    Higher-order functions run interpreted, so an expression that appears
    several times in a lambda body would be recomputed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(col, remove_censored: bool = False) -> Column:
    """Remove filler tokens and immediate repeats from a transcript.

    nbsp -> space, runs of spaces collapse to one, split on single spaces
    (newline/tab are not separators), drop exact filler tokens, then drop a
    token equal to its right neighbour (the last token's neighbour is '',
    so a trailing empty token disappears while a leading one stays).
    ``remove_censored`` also removes the three-token censor mark "[ __ ]",
    which can never match as a single token.
    """
    t = F.translate(_c(col), " ", " ")
    if remove_censored:
        t = F.regexp_replace(t, r"\[ __ \]", "")
    t = F.regexp_replace(t, " +", " ")
    toks = F.split(t, " ", -1)
    stop = [F.lit(s) for s in FILLER_TOKENS]
    kept = F.filter(toks, lambda x: ~x.isin(*stop))

    def dedupe(k):
        # pair every kept token with its right neighbour ('' after the last)
        nxt = F.slice(k, 2, F.greatest(F.size(k), F.lit(1)))
        pairs = F.zip_with(k, nxt, lambda x, y: F.when(x != F.coalesce(y, F.lit("")), x))
        return F.array_join(F.filter(pairs, lambda x: x.isNotNull()), " ")
    return _let(kept, dedupe)


def html_unescape_basic(col) -> Column:
    """The two entity replacements applied to listing titles: &#39; then &amp;."""
    c = F.replace(_c(col), F.lit("&#39;"), F.lit("'"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def tokens(col) -> Column:
    """Token array of the whole text."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), 0)


def token_count(col) -> Column:
    return F.size(tokens(col)).cast("long")


def words(col, min_letters: int = 1) -> Column:
    """Lower-cased words of at least ``min_letters`` letters."""
    pattern = WORD_PATTERN if min_letters == 1 else r"\p{L}{%d,}" % min_letters
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(pattern), 0)


def chunk_text(col, limit: int = CHUNK_TOKEN_LIMIT) -> Column:
    """Array of chunks: the text itself below ``limit`` tokens, else
    ``k = ceil(n / limit)`` even parts of the token list re-joined by a space.
    Part i holds tokens floor(i*n/k) .. floor((i+1)*n/k)-1 (integer bounds).
    The token list is built once per text."""
    text = _c(col)

    def split(tok):
        n = F.size(tok)
        k = F.greatest(F.lit(1), F.ceil(n / F.lit(limit)).cast("int"))

        def part(i):
            lo = F.floor(i * n / k).cast("int")
            hi = F.floor((i + 1) * n / k).cast("int")
            return F.array_join(F.slice(tok, lo + 1, hi - lo), " ")
        return F.when(n < F.lit(limit), F.array(text)).otherwise(
            F.transform(F.sequence(F.lit(0), k - 1), part))
    return _let(tokens(text), split)


def split_topics(col, trim: bool = False, drop_empty: bool = False) -> Column:
    """Split a comma-separated topic list; by default no trim, empties kept."""
    arr = F.split(_c(col), ",", -1)
    if trim:
        arr = F.transform(arr, lambda x: F.trim(x))
    if drop_empty:
        arr = F.filter(arr, lambda x: x != F.lit(""))
    return arr


def strip_suffix(col, suffix: str) -> Column:
    """Key from a file name: every occurrence of ``suffix`` removed."""
    return F.replace(_c(col), F.lit(suffix), F.lit(""))


def lower_equals(col, value: str) -> Column:
    """Case-insensitive equality with a literal."""
    return F.lower(_c(col)) == F.lower(F.lit(value))


# A sentence: shortest run ending at . ! ? (or the end of the text).
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"


def sentences(col) -> Column:
    """Trimmed, non-empty sentences of the whole text, in reading order."""
    raw = F.regexp_extract_all(_c(col), F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(raw, lambda s: F.trim(s)), lambda s: s != F.lit(""))
