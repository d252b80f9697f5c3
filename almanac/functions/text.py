"""Text expressions; all of them stay inside the JVM and work on whole texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern, shortest TF-IDF term, chunk length in tokens.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
MIN_TERM_LENGTH = 2
CHUNK_TOKENS = 500

# Page elements cut with their contents, entities decoded, white space squeezed.
CUT_ELEMENTS = ["script", "style", "noscript", "template", "head", "nav"]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
WHITE_SPACE = r"[ \t\n\f\r]+"


def html_rules() -> list[tuple[str, str]]:
    """(pattern, replacement) pairs that turn a page into text, in the order they apply."""
    cut = [(rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ") for name in CUT_ELEMENTS]
    return [(r"(?s)<!--.*?-->", " "), *cut, (r"<[^>]*>", " "), *ENTITIES, (WHITE_SPACE, " ")]


def combined_text(title: Column, content: Column) -> Column:
    """Title and content with one space; NULL when either is NULL."""
    return F.concat(title, F.lit(" "), content)


def tokens(text: Column) -> Column:
    """Lower-case word tokens in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def token_text(words: Column) -> Column:
    return F.array_join(words, " ")


def token_chunks(words: Column, size: int = CHUNK_TOKENS) -> Column:
    """Consecutive slices of `size` tokens; the last may be short, empty text has none."""
    starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(size))
    slices = F.transform(starts, lambda start: F.slice(words, start + 1, size))
    return F.when(F.size(words) > 0, slices).otherwise(F.array().cast("array<array<string>>"))


def sentences(text: Column) -> Column:
    """Sentences in order: a break follows . ! or ? and white space, or a line end."""
    broken = F.regexp_replace(text, r"([.!?])[ \t\n\f\r]+", "$1\n")
    return F.filter(F.transform(F.split(broken, "\n"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def html_to_text(html: Column) -> Column:
    """Readable text of a page: markup and furniture cut, entities decoded, space squeezed."""
    cleaned = reduce(lambda text, rule: F.regexp_replace(text, rule[0], rule[1]), html_rules(), html)
    return F.trim(cleaned)
