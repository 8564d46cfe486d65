"""Small helpers that the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwave.session import shared_dir

# Regular expression of a run of ASCII white space, as Java and DuckDB read it.
SPACE_RUN = r"[\x20\x09-\x0D]+"
# Text handed to one step of Python work at a time, in characters: bounds the
# words that live in a worker, whatever the number or length of the texts.
STEP_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: Column) -> Column:
    """Words of a text split at ASCII white space; none for null and empty texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Later steps then start from files every executor can read, so a lost
    executor costs one task and not the whole chain before it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of all columns; all rows of a small table.

    Only for fitting a model or timing a rule, never for a result.
    """
    step = max(1, df.count() // rows)
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(step)) == 0)


def steps(batches: Iterator[pa.RecordBatch], text_col: str,
          limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text.

    A single text is never cut, so one longer than ``limit`` comes alone.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(
            zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += int(n)
        if at < batch.num_rows:
            yield batch.slice(at)


def per_row(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict],
            text_col: str, limit: int = STEP_CHARS) -> DataFrame:
    """Run ``work`` on bounded record batches; it returns the new columns by name.

    The result has the columns of ``schema``; those ``work`` does not return
    are taken over from the batch.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in steps(batches, text_col, limit):
            made = work(batch)
            cols = [made[f.name] if f.name in made else batch.column(f.name) for f in arrow]
            cols = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                    for c, f in zip(cols, arrow)]
            yield pa.RecordBatch.from_arrays(
                [c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, arrow)],
                schema=arrow)

    return df.mapInArrow(run, schema)


def type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()
