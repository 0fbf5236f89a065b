"""Vector arithmetic on array columns, in double precision.

A complex vector of size 2n is stored as n real parts followed by n imaginary parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLEX = "complex_diagonal"
TRANSLATION = "translation"


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def complex_product(vector: Column, real: Column, imag: Column) -> Column:
    """Coordinate-wise (a+bi)(c+di)."""
    x, c, d = doubles(vector), doubles(real), doubles(imag)
    n = F.size(real)
    coordinates = F.sequence(F.lit(0), n - 1)
    return F.concat(
        F.transform(coordinates, lambda i: x[i] * c[i] - x[i + n] * d[i]),
        F.transform(coordinates, lambda i: x[i] * d[i] + x[i + n] * c[i]),
    )


def translate(vector: Column, translation: Column) -> Column:
    return F.zip_with(doubles(vector), doubles(translation), lambda a, t: a + t)


def project(vector: Column, kind: Column, real: Column, imag: Column, translation: Column) -> Column:
    """Apply a relation operator row to a vector."""
    return (
        F.when(kind == F.lit(COMPLEX), complex_product(vector, real, imag))
        .when(kind == F.lit(TRANSLATION), translate(vector, translation))
        .otherwise(F.raise_error(F.concat(F.lit("unknown operator kind: "), kind)))
    )


def inner_product(left: Column, right: Column) -> Column:
    products = F.zip_with(doubles(left), doubles(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda total, p: total + p)


def operator_side(direction: Column) -> Column:
    """``left`` asks subject + relation -> object with the left operator; anything else is the other way round."""
    return F.when(direction == F.lit("left"), F.lit("lhs")).otherwise(F.lit("rhs"))
