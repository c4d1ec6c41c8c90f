"""Pre-training text templates.

Templates are assembled with ``concat``: braces or ``%`` inside titles and
texts stay inert, as with ``str.format`` placeholders in the template only.
A null field renders as the empty string (``coalesce``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import DICTIONARY_TEMPLATE, EOS_TEXT, LITERATURE_TEMPLATE
from tessera.functions.text import fill_template


def _s(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def literature_text(title="title", text="text", eos: str = EOS_TEXT) -> Column:
    """Title and body template followed by the end-of-sequence text."""
    return F.concat(fill_template(LITERATURE_TEMPLATE, title=_s(title), text=_s(text)), F.lit(eos))


def dictionary_text(text="text", eos: str = EOS_TEXT) -> Column:
    """Body-only template followed by the end-of-sequence text."""
    return F.concat(fill_template(DICTIONARY_TEMPLATE, text=_s(text)), F.lit(eos))


def map_overwrite(df: DataFrame, expr: Column, col: str = "text") -> DataFrame:
    """The mapped value replaces ``col``; every other column stays."""
    return df.withColumn(col, expr)


def drop_source_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep only the listed (token) columns."""
    return df.select(*keep)


def literature_text_sql(title: str = "title", text: str = "text", eos: str = EOS_TEXT) -> str:
    return _template_sql(LITERATURE_TEMPLATE, {"title": title, "text": text}, eos)


def dictionary_text_sql(text: str = "text", eos: str = EOS_TEXT) -> str:
    return _template_sql(DICTIONARY_TEMPLATE, {"text": text}, eos)


def _template_sql(template: str, columns: dict[str, str], eos: str) -> str:
    """``concat`` of the template's literals and its columns (null reads as empty)."""
    parts = [f"coalesce({columns[p]}, '')" if i % 2 else f"'{_q(p)}'" for i, p in enumerate(re.split(r"\{(\w+)\}", template)) if p]
    return "concat(" + ", ".join([*parts, f"'{eos}'"]) + ")"


def _q(s: str) -> str:
    """A SQL string literal body: quotes doubled, newlines via chr(10) splice."""
    return s.replace("'", "''").replace("\n", "' || chr(10) || '")
