"""Table schemas. Columns are always selected by name, never by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIPLE = _table(subj=T.StringType(), rel=T.StringType(), obj=T.StringType())
ENTITY = _table(index=T.IntegerType(), ent=T.StringType(), partition=T.IntegerType())
RELATION = _table(index=T.IntegerType(), relation=T.StringType())
CODED = _table(
    subj=T.IntegerType(),
    obj=T.IntegerType(),
    rel=T.IntegerType(),
    part_left=T.IntegerType(),
    part_right=T.IntegerType(),
)
NAMES = _table(
    name=T.StringType(),
    ent=T.StringType(),
    count=T.LongType(),
    index=T.IntegerType(),
    partition=T.IntegerType(),
)
WORD_INDEX = _table(word=T.StringType(), uri=T.StringType())
EMBEDDING = _table(
    partition=T.IntegerType(),
    index=T.IntegerType(),
    embedding=T.ArrayType(T.FloatType()),
)
NORMED = T.StructType([*EMBEDDING.fields, T.StructField("norm", T.DoubleType())])
OPERATOR = _table(
    rel=T.IntegerType(),
    side=T.StringType(),
    kind=T.StringType(),
    real=T.ArrayType(T.FloatType()),
    imag=T.ArrayType(T.FloatType()),
    translation=T.ArrayType(T.FloatType()),
)
KNN_REQUEST = _table(
    query_id=T.LongType(),
    entity=T.StringType(),
    relation=T.StringType(),
    k=T.IntegerType(),
    direction=T.StringType(),
)
SEARCH_REQUEST = _table(
    query_id=T.LongType(),
    query=T.StringType(),
    limit=T.IntegerType(),
    offset=T.IntegerType(),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` by name; fail if one is missing."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
