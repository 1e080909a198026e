"""Text helpers for parameter vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters / sequences removed from a parameter text, and the
# word tokenizer's filter characters (lower-cased text, these become blanks).
PARAM_CLEAN_PATTERN = r"=|/|#|:|\[|\]|'|\s+|\.|-|\(|\)|rhost=|,"
TOKENIZER_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def py_list_repr(tokens: Column) -> Column:
    """Text of a Python list of strings, e.g. ``['a', "b'c"]``."""
    def one(t):
        esc = F.replace(t, F.lit("\\"), F.lit("\\\\"))
        dq = F.instr(t, "'") > 0
        sq_ok = F.instr(t, '"') == 0
        return F.when(dq & sq_ok, F.concat(F.lit('"'), esc, F.lit('"'))) \
            .otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(tokens, one), ", "), F.lit("]"))


def clean_param(text: Column) -> Column:
    """Remove separators and the ``rhost=`` prefix from one parameter text."""
    return F.regexp_replace(text, "(?U)" + PARAM_CLEAN_PATTERN, "")


def tokenizer_words(text: Column) -> Column:
    """Words of a text: lower-case, filter characters to blanks, split, drop empties."""
    lowered = F.lower(text)
    blanks = F.translate(lowered, TOKENIZER_FILTERS, " " * len(TOKENIZER_FILTERS))
    return F.filter(F.split(blanks, " "), lambda w: w != F.lit(""))
