"""Type a frame of strings and keep what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Columns of a row that the schema does not know: a map of name to text.
UNKNOWN = "_unknown_columns"


def type_and_rescue(raw: DataFrame, schema: T.StructType, file_path: Column) -> DataFrame:
    """Cast each declared column; put misfit values into ``_rescued_data`` as JSON.

    The JSON object maps column to original text, with the file in ``_file_path``. It is
    NULL where every value fits. What a map column ``_unknown_columns`` holds is rescued as
    well and the column dropped; other columns outside ``schema`` pass through untouched.
    """
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    declared = set(schema.fieldNames())
    others = [c for c in raw.columns if c not in declared and c != UNKNOWN]

    misfits = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.col(f.name)
        ).alias(f.name)
        for f in typed
    ]
    # to_json leaves out NULL fields, so only the misfits are named.
    file_field = file_path.alias("_file_path")
    misfit = F.coalesce(*misfits, F.lit(None)).isNotNull()
    rescued = F.when(misfit, F.to_json(F.struct(*misfits, file_field)))
    if UNKNOWN in raw.columns:
        known = F.when(misfit, F.from_json(F.to_json(F.struct(*misfits)), "map<string,string>"))
        every = F.map_concat(
            F.coalesce(known, F.create_map().cast("map<string,string>")),
            F.col(UNKNOWN),
            F.create_map(F.lit("_file_path"), file_path),
        )
        rescued = F.when(F.size(UNKNOWN) > 0, F.to_json(every)).otherwise(rescued)

    return raw.select(
        *[
            F.col(f.name) if isinstance(f.dataType, T.StringType)
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *others,
        rescued.alias("_rescued_data"),
    )
