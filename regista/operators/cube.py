"""Statistical cubes: a flat value array plus its dimensions, decoded into long tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regista.functions.document import array_product, member_codes
from regista.functions.scalar import trunc_to_long

# --- Fixed values: position of the two measures of a territory in the value array ---
ELDERLY_POSITION = 0
TOTAL_POSITION = 1


def _single_year(codes: Column) -> Column:
    found = F.concat(F.lit("expected one YEAR member, got "), F.array_size(codes).cast("string"))
    return F.when(F.array_size(codes) == 1, codes[0]).otherwise(F.raise_error(found))


def decode_cube(size: Column, codes: Column, values: Column) -> Column:
    """array of struct(code, first, second): one entry per territory without the last, the total.

    The measures are the last dimension, so the last size is their number and the stride of a
    territory. A value array that is not as long as the sizes say, another number of codes than
    territories and fewer than two measures fail the job; NULL measures are JSON nulls only.
    """
    measures = F.element_at(size, -1).cast("int")
    cells = array_product(size)
    territories = F.when(
        (measures > TOTAL_POSITION) & (F.array_size(values) == cells) & (F.array_size(codes) * measures == cells),
        F.array_size(codes) - 1,
    ).otherwise(F.raise_error(F.concat(
        F.lit("cube of sizes "), F.to_json(size), F.lit(" has "), F.array_size(values).cast("string"),
        F.lit(" values and "), F.array_size(codes).cast("string"), F.lit(" codes"),
    )).cast("int"))

    def entry(code: Column, position: Column) -> Column:
        at = position * measures
        return F.struct(
            code.alias("code"),
            F.get(values, at + F.lit(ELDERLY_POSITION)).alias("first"),
            F.get(values, at + F.lit(TOTAL_POSITION)).alias("second"),
        )

    return F.transform(F.slice(codes, 1, territories), entry)


def census_rows(cubes: DataFrame) -> DataFrame:
    """Census cubes to (municipal_code, population_ge65, population, year).

    A cube with other than one YEAR member fails the job. Values are truncated to integers.
    """
    year = _single_year(member_codes(F.col("dimension.YEAR.category.index"))).cast("bigint")
    codes = member_codes(F.col("dimension.MUN.category.index"))
    return cubes.select(
        year.alias("year"), F.inline(decode_cube(F.col("size"), codes, F.col("value")))
    ).select(
        F.col("code").alias("municipal_code"),
        trunc_to_long(F.col("first")).alias("population_ge65"),
        trunc_to_long(F.col("second")).alias("population"),
        "year",
    )
