"""Keep going with the good rows, and keep the bad ones where they can be looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

CORRUPT = "_corrupt"


def decode_messages(messages: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records of the JSON texts, and the messages that hold no such record."""
    with_mark = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = messages.withColumn(
        "_r", F.from_json(F.col(value).cast("string"), with_mark, {"columnNameOfCorruptRecord": CORRUPT})
    )
    bad = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    others = [c for c in messages.columns if c != value]
    records = parsed.where(~bad).select(*others, *[F.col(f"_r.`{f.name}`") for f in schema])
    return records, parsed.where(bad).drop("_r")


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows cast to the schema, and the rows of which a value could not be cast.

    The good rows come out of a generator, not a filter: from a filter over the casts followed by
    the casts themselves, the optimizer derives twice as many constraints with every column.
    """
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    flags = [
        F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema if df.schema[f.name].dataType != f.dataType
    ]
    if not flags:
        return df.select(*cast), df.where(F.lit(False))
    lost = F.array_contains(F.array(*flags), True)
    return df.select(F.inline(F.when(~lost, F.array(F.struct(*cast))))), df.where(lost)
