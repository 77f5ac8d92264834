"""The engine's functions from SQL text.

`register` adds to a session:

- geoweave_normalize(text) and geoweave_normalize_url(text): the normalised text;
- geoweave_excerpt(text): at most 240 characters.

`register_names` adds, for a gazetteer of few names (see `operators.matching.MAX_NAMES`) and under a prefix:

- <prefix>_names_in(text): the different names in a text, by first occurrence;
- <prefix>_mentions(TABLE(...), 'column'): a table function. Its rows are those of the given table, without the text column,
  once for each mention, with name, start_char, end_char (in the original text) and sentence.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from geoweave.functions.text import exact_text
from geoweave.operators.matching import broadcast_names, mentions_by_sentence, name_index, names_of

#: Columns that the table function adds.
MENTION = StructType().add("name", StringType()).add("start_char", IntegerType()).add("end_char", IntegerType()).add("sentence", StringType())


def register(spark: SparkSession) -> None:
    @F.pandas_udf("string")
    def normalize(texts: pd.Series) -> pd.Series:
        return texts.map(exact_text)

    @F.pandas_udf("string")
    def normalize_url(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: exact_text(t, True))

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or len(t) <= 240 else f"{t[:239]}…")

    for name, function in (("geoweave_normalize", normalize), ("geoweave_normalize_url", normalize_url), ("geoweave_excerpt", cut)):
        spark.udf.register(name, function)


def register_names(spark: SparkSession, names: DataFrame, *, column: str = "normalized_name", prefix: str = "gazetteer") -> None:
    few = broadcast_names(names, column)
    if few is None:
        raise ValueError("too many names for functions of SQL; use operators.matching")
    shared = spark.sparkContext.broadcast(name_index(few))

    @F.pandas_udf("array<string>")
    def names_in(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: names_of(exact_text(t), shared.value))

    class Mentions:
        @staticmethod
        def analyze(table: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
            if not table.isTable or not isinstance(table.dataType, StructType):
                raise ValueError("the first argument is a TABLE(...)")
            if column.value not in table.dataType.names:
                raise ValueError(f"the table has no column {column.value}")
            kept = [f for f in table.dataType.fields if f.name != column.value]
            clash = sorted({f.name for f in kept} & set(MENTION.names))
            if clash:
                raise ValueError(f"the table has columns of the result: {', '.join(clash)}")
            return AnalyzeResult(StructType([*kept, *MENTION.fields]))

        def eval(self, row, column: str):
            found = row.asDict(recursive=False)
            text = found.pop(column)
            for _, sentence, _, _, _, _, _, told, starts, ends in mentions_by_sentence(text or "", shared.value):
                for name, start, end in zip(told, starts, ends, strict=True):
                    yield (*found.values(), name, start, end, sentence)

    spark.udf.register(f"{prefix}_names_in", names_in)
    spark.udtf.register(f"{prefix}_mentions", F.udtf(Mentions))
