"""Text functions: line split (T1), Java-compatible word split."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators of a line reader: "\r\n", "\r" or "\n". A terminator at the
# very end does not open another (empty) line, and empty text has no line.
_EOL = r"\r\n|\r|\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """array<string> of the lines of ``text``."""
    t = _col(text)
    # \z is the absolute end; a Java "$" would also match before a final "\n".
    body = F.regexp_replace(t, rf"({_EOL})\z", "")
    return (F.when(t == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, _EOL)))


def split_words(line: Column | str) -> Column:
    """array<string> of the words of ``line``, split on a single space.

    Same result as ``java.util.regex.Pattern.compile(" ").split(line)``:
    leading and inner empty words are kept, trailing ones dropped; a line
    without a space is one word (also the empty line); a line of spaces only
    has no word. Spark's ``rtrim`` strips spaces only, like the rule needs.
    """
    s = _col(line)
    return (F.when(~s.contains(" "), F.array(s))
            .when(F.rtrim(s) == "", F.array().cast("array<string>"))
            .otherwise(F.split(F.rtrim(s), " ")))


def fill(template: str, **parts: Column) -> Column:
    """``template`` with ``{name}`` placeholders filled by Columns (concat)."""
    pieces = []
    for i, chunk in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(parts[chunk])
        elif chunk:
            pieces.append(F.lit(chunk))
    return F.concat(*pieces)
