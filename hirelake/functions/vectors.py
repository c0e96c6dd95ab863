"""ML vectors as plain columns and back, without a Python function per row."""

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VECTOR = T.StructType([T.StructField("v", VectorUDT())])


def sparse_vector(size, indices, values) -> Column:
    """A sparse vector from arrays of ascending positions and their values."""
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), size.alias("size"), indices.alias("indices"), values.alias("values")
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


class SublinearTf(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Turns the term counts of a sparse vector into 1 + ln(count)."""

    def __init__(self, inputCol: str = "counts", outputCol: str = "tf"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        v = F.unwrap_udt(F.col(self.getInputCol()))
        damped = F.transform(v["values"], lambda n: 1 + F.log(n))
        return dataset.withColumn(self.getOutputCol(), sparse_vector(v["size"], v["indices"], damped))
