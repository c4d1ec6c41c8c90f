"""Scalar text functions as Spark column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.constants import WS29


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fill_template(template: str, **columns: Column) -> Column:
    """Fill the ``{name}`` placeholders of a fixed template; braces in the data stay inert."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])


def strip_unicode(col) -> Column:
    """P5: remove the 29 whitespace code points of ``str.strip`` from both ends."""
    return F.btrim(_c(col), F.lit(WS29))


def default_missing(col) -> Column:
    """An absent (null) field reads as the empty string."""
    return F.coalesce(_c(col), F.lit(""))


def clean_field(col) -> Column:
    """P5 + P6: ``example.get(k, "").strip()``."""
    return strip_unicode(default_missing(col))


def build_user_content(instruction, input_text) -> Column:
    """Instruction and input joined by a newline, then stripped again."""
    return strip_unicode(F.concat(clean_field(instruction), F.lit("\n"), clean_field(input_text)))


@F.pandas_udf(StringType())
def _scientific(values: pd.Series) -> pd.Series:
    """``%e`` of the exact binary value (the JVM rounds its shortest decimal text)."""
    return pd.Series([None if pd.isna(v) or abs(v) == float("inf") else f"{v:e}" for v in values], dtype=object)


def format_lr(col) -> Column:
    """``2.5e-4`` style text of a learning rate.

    Mantissa from ``%e`` with trailing zeros (and a bare dot) removed; the
    exponent printed as a plain integer. Infinite or NaN input gives null.
    """
    sci = _scientific(_c(col).cast("double"))
    mant = F.regexp_replace(F.regexp_replace(F.split(sci, "e").getItem(0), "0+$", ""), "\\.$", "")
    expo = F.split(sci, "e").getItem(1).cast("int").cast("string")
    return F.concat(mant, F.lit("e"), expo)


def checkpoint_path(output_dir, step) -> Column:
    """``{output_dir}/checkpoint-{step}``."""
    return F.concat_ws("/", _c(output_dir), F.concat(F.lit("checkpoint-"), _c(step).cast("string")))


def parent_label(path) -> Column:
    """The second-to-last path element (``split('/')[-2]``)."""
    return F.element_at(F.split(_c(path), "/"), -2)


def with_fixed(df: DataFrame, col: str, out: str, decimals: int = 4) -> DataFrame:
    """Add ``out`` = ``f"{col:.Nf}"``: half-even rounding of the exact binary value.

    Spark's ``format_string`` rounds the shortest decimal text half-up
    (0.03125 -> 0.0313) and ``format_number`` misses near-ties; Python and
    DuckDB round the exact value. Here ``|x| = M / 2**k`` exactly (``M`` a
    53-bit integer) and ``M * 10**N`` is divided by ``2**k`` in exact decimal
    arithmetic. Staged projections keep every intermediate computed once.
    Valid for ``|x| < 1e12``; larger values, infinities and NaN print as Spark's own text
    of the double, null stays null.
    """
    dec = "decimal(38,0)"
    one = F.lit(1).cast("bigint")
    x = F.col(col).cast("double")
    fits = ~F.isnan(x) & (F.abs(x) < 1e12)
    d = df.withColumn("_fx", F.when(fits, x))
    d = d.withColumn("_fa", F.abs("_fx"))
    d = d.withColumn("_fk", F.lit(52) - F.floor(F.log2("_fa")).cast("int"))
    d = d.withColumn("_fm", F.col("_fa") * F.pow(F.lit(2.0), F.col("_fk")))
    d = d.withColumn("_fk", F.when(F.col("_fm") >= 2.0 ** 53, F.col("_fk") - 1)
                     .when(F.col("_fm") < 2.0 ** 52, F.col("_fk") + 1).otherwise(F.col("_fk")))
    d = d.withColumn("_fkh", F.least(F.col("_fk"), F.lit(60)))
    d = d.withColumn("_fden", (F.call_function("shiftleft", one, F.col("_fkh")).cast(dec)
                               * F.call_function("shiftleft", one, F.col("_fk") - F.col("_fkh")).cast(dec)).cast(dec))
    d = d.withColumn("_fnum", ((F.col("_fa") * F.pow(F.lit(2.0), F.col("_fk"))).cast("bigint").cast(dec)
                               * F.lit(10 ** decimals).cast(dec)).cast(dec))
    d = d.withColumn("_fq", F.call_function("div", F.col("_fnum"), F.col("_fden")).cast("bigint"))
    d = d.withColumn("_fr2", ((F.col("_fnum") - F.col("_fq").cast(dec) * F.col("_fden")) * F.lit(2).cast(dec)).cast(dec))
    up = (F.col("_fr2") > F.col("_fden")) | ((F.col("_fr2") == F.col("_fden")) & (F.col("_fq") % 2 == 1))
    d = d.withColumn("_fq", F.when(F.col("_fa") < 1e-30, F.lit(0).cast("bigint"))
                     .when(up, F.col("_fq") + 1).otherwise(F.col("_fq")))
    scale = 10 ** decimals
    ip = F.floor(F.col("_fq") / F.lit(scale)).cast("bigint").cast("string")
    text = F.concat(ip, F.lit("."), F.lpad((F.col("_fq") % F.lit(scale)).cast("string"), decimals, "0")) \
        if decimals else ip
    sign = F.when(F.col("_fx") < 0, F.lit("-")).otherwise(F.lit(""))
    d = d.withColumn(out, F.when(F.col("_fx").isNotNull(), F.concat(sign, text)).otherwise(F.lower(x.cast("string"))))
    return d.drop("_fx", "_fa", "_fk", "_fm", "_fkh", "_fden", "_fnum", "_fq", "_fr2")
