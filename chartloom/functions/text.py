"""Text parsing and categorisation expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mean themselves in a regular expression.
_PLAIN = re.compile("[A-Za-z0-9 ,/_-]+")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_comment_number(comment: Column | str) -> Column:
    """First number in a free-text comment.

    NULL when the comment says the test was not done or could not be reported, except for the
    clotting-time wording that still carries a usable bound.
    """
    text = _c(comment)
    lower = F.lower(text)
    # Fixed value: the number pattern.
    number = F.regexp_extract(text, r"\d+\.\d+|\d+", 0).try_cast("double")
    unable = lower.contains("unable")
    return F.when(lower.contains("ptt") & unable, number).when(~(lower.contains("not done") | unable), number)


def extract_number(text: Column | str, pattern: str = r"[\d\.]+", dtype: str = "float") -> Column:
    """First match of ``pattern`` as a number; NULL where there is none."""
    return F.regexp_extract(_c(text), pattern, 0).try_cast(dtype)


def text_after(text: Column | str, delimiter: str = ":", part: int = 2) -> Column:
    return F.split_part(_c(text), F.lit(delimiter), F.lit(part))


def normalise_whitespace(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"\s+", " "))


def join_present(*cols: Column | str, sep: str = "; ") -> Column:
    """Concatenate the non-NULL parts."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def text_to_ordinal(text: Column | str, words: Sequence[str]) -> Column:
    """Position (from 1) of the text in an ordered word list; NULL outside it."""
    return F.nullif(F.array_position(F.array(*[F.lit(w) for w in words]), _c(text)), F.lit(0).cast("bigint")).cast("int")


def strict_sum(*cols: Column | str) -> Column:
    """Sum that is NULL as soon as one part is NULL."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def prefix_number(text: Column | str, width: int = 3) -> Column:
    """Number written in the first ``width`` characters."""
    return F.trim(F.substring(_c(text), 1, width)).try_cast("double")


def three_valued_delirium(mental: Column, inattention: Column, thinking: Column, loc: Column) -> Column:
    """Positive / Negative / NULL under SQL three-valued logic."""

    def says(c: Column, word: str) -> Column:
        return c.contains(word)

    positive = says(mental, "Yes") & says(inattention, "Yes") & (says(thinking, "Yes") | says(loc, "Yes"))
    negative = says(mental, "No") | says(inattention, "No") | (says(thinking, "No") & says(loc, "No"))
    return F.when(positive, "Positive").when(negative, "Negative")


def classify_code(code: Column | str, rules: Sequence[tuple[str, str]] | None = None) -> Column:
    """First matching pattern gives the code system; NULL if none does."""
    # Code patterns and their systems.
    rules = rules or [
        ("^[0-9]{5}$", "CPT"),
        ("^[0-9]{4}[FT]$", "CPT"),
        ("^[A-V][0-9]{4}$", "HCPCS"),
    ]
    return first_match(code, rules)


def case_map(col: Column | str, mapping: Mapping, default: str | int | None = None) -> Column:
    """Constant CASE map, with a default for everything else."""
    source = _c(col)
    out = reduce(
        lambda acc, kv: acc.when(source == kv[0], kv[1]),
        list(mapping.items())[1:],
        F.when(source == next(iter(mapping)), next(iter(mapping.values()))),
    )
    return out if default is None else out.otherwise(default)


def null_if(col: Column | str, sentinel: str = "NA") -> Column:
    return F.nullif(_c(col), F.lit(sentinel))


def found_in(source: Column, pattern: str) -> Column:
    """``source.rlike(pattern)``, where alternatives that are plain words are looked for without a regular expression.

    Java tries every alternative at every place of a text, so a long list of words costs far more than looking for each. A word
    between word bounds is looked for first, and only texts that hold it meet the expression. Patterns with flags, classes,
    alternatives within groups, or escapes other than of bounds and bars are left whole.
    """
    alternatives = re.split(r"(?<!\\)\|", pattern)
    if re.search(r"\(\?|\[|\\[^b|]", pattern) or any(a.count("(") != a.count(")") for a in alternatives):
        return source.rlike(pattern)
    words = [a for a in alternatives if _PLAIN.fullmatch(a)]
    words = [w for w in words if not any(v != w and v in w for v in words)]  # what holds a longer word holds the shorter
    bounded = {a: a.removeprefix(r"\b").removesuffix(r"\b") for a in alternatives if not _PLAIN.fullmatch(a)}
    hits = [source.contains(w) for w in dict.fromkeys(words)]
    hits += [source.contains(w) & source.rlike(a) for a, w in bounded.items() if _PLAIN.fullmatch(w)]
    others = [a for a, w in bounded.items() if not _PLAIN.fullmatch(w)]
    return reduce(lambda a, b: a | b, [*hits, source.rlike("|".join(others))] if others else hits)


def first_match(
    col: Column | str, rules: Sequence[tuple[str, str]], ignore_case: bool = False, default: Column | None = None
) -> Column:
    """Ordered regex rules: the first pattern that is found decides the category, else ``default``."""

    def cases(source: Column) -> Column:
        out = None
        for pattern, category in rules:
            # lower-cased text needs the flag only for patterns with capitals of their own
            hit = found_in(source, "(?i)" + pattern if ignore_case and pattern != pattern.lower() else pattern)
            out = F.when(hit, category) if out is None else out.when(hit, category)
        return out

    # the one-element transform binds the lower-cased text once for all rules
    found = F.transform(F.array(F.lower(_c(col))), cases)[0] if ignore_case else cases(_c(col))
    return found if default is None else F.coalesce(found, default)


def split_genus_species(name: Column | str, sep: str = "_") -> tuple[Column, Column]:
    parts = F.split(_c(name), sep)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def similarity(a: Column | str, b: Column | str) -> Column:
    """Levenshtein ratio in 0..100, case-insensitive."""
    x, y = F.lower(_c(a)), F.lower(_c(b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(100.0)).otherwise(100.0 * (1 - F.levenshtein(x, y) / longest))
