"""Code books and the columns that turn codes into labels and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# State code, name as the silver layer writes it, name with accents.
STATES = (
    (11, "Rondonia", "Rondônia"),
    (12, "Acre", "Acre"),
    (13, "Amazonas", "Amazonas"),
    (14, "Roraima", "Roraima"),
    (15, "Para", "Pará"),
    (16, "Amapa", "Amapá"),
    (17, "Tocantins", "Tocantins"),
    (21, "Maranhao", "Maranhão"),
    (22, "Piaui", "Piauí"),
    (23, "Ceara", "Ceará"),
    (24, "Rio Grande do Norte", "Rio Grande do Norte"),
    (25, "Paraiba", "Paraíba"),
    (26, "Pernambuco", "Pernambuco"),
    (27, "Alagoas", "Alagoas"),
    (28, "Sergipe", "Sergipe"),
    (29, "Bahia", "Bahia"),
    (31, "Minas Gerais", "Minas Gerais"),
    (32, "Espirito Santo", "Espírito Santo"),
    (33, "Rio de Janeiro", "Rio de Janeiro"),
    (35, "Sao Paulo", "São Paulo"),
    (41, "Parana", "Paraná"),
    (42, "Santa Catarina", "Santa Catarina"),
    (43, "Rio Grande do Sul", "Rio Grande do Sul"),
    (50, "Mato Grosso do Sul", "Mato Grosso do Sul"),
    (51, "Mato Grosso", "Mato Grosso"),
    (52, "Goias", "Goiás"),
    (53, "Distrito Federal", "Distrito Federal"),
)

# First state code, last state code, region.
REGIONS = (
    (11, 17, "Norte"),
    (21, 29, "Nordeste"),
    (31, 35, "Sudeste"),
    (41, 43, "Sul"),
    (50, 53, "Centro-Oeste"),
)

# Small domains.
SEX = {1: "Masculino", 2: "Feminino"}
RACE = {1: "Branca", 2: "Preta", 3: "Amarela", 4: "Parda", 5: "Indigena"}
HEALTH_PLAN = {1: "Com plano de saude", 2: "Sem plano de saude"}
HOUSEHOLD = {1: "Urbano", 2: "Rural"}
MONTHS = {9: "Set", 10: "Out", 11: "Nov"}

UNKNOWN = "Desconhecido"
NOT_INFORMED = "Nao informado"

STATE_NAMES = {code: plain for code, plain, _ in STATES}
STATE_NAMES_ACCENTED = {code: accented for code, _, accented in STATES}

ACCENTED, UNACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"

# Numbers in a bucket, as a power of two, in which codes meet ranges: what one group of a window may hold.
BUCKET_BITS = 12


def code_label(code: Column, book: Mapping, default: str | Column) -> Column:
    """Label of an exactly matching code; any other code and NULL get the default.

    Where the book's keys are integers, codes of any type count as the whole number they are: `"11"` and 11.0 match
    11, while 11.7, 11.9999999, malformed text and numbers beyond the keys match nothing (of text, 18 decimals count). A book is held as a literal that Spark
    searches linearly: beyond a few dozen entries use `label_from_table`.
    """
    if all(isinstance(key, int) for key in book):
        number = code.try_cast("decimal(38,18)")
        code = F.when(number == F.floor(number), number).try_cast("bigint")
        keys = F.array(*[F.lit(key).cast("bigint") for key in book])
        place = F.nullif(F.array_position(keys, code), F.lit(0).cast("bigint")).cast("int")
        label = F.get(F.array(*[F.lit(text) for text in book.values()]), place - 1)
    else:
        label = F.try_element_at(literal_map(book), code)
    return F.coalesce(label, default if isinstance(default, Column) else F.lit(default))


def range_label(code: Column, ranges: Sequence[tuple], default: str) -> Column:
    """Label of the first inclusive range holding the code; outside all ranges and NULL get the default."""
    (low, high, label), *others = ranges
    labelled = F.when(code.between(low, high), label)
    for low, high, label in others:
        labelled = labelled.when(code.between(low, high), label)
    return labelled.otherwise(default)


def label_from_table(
    df: DataFrame, code: str, book: DataFrame, key: str, value: str, label: str, default: str
) -> DataFrame:
    """Label from a code-book table with unique keys.

    A plain left join: Spark broadcasts the book when its size allows and shuffles otherwise.
    """
    named = book.select(F.col(key).alias("_book_key"), F.col(value).alias("_book_value"))
    joined = df.join(named, F.col(code) == F.col("_book_key"), "left")
    return joined.select(*df.columns, F.coalesce("_book_value", F.lit(default)).alias(label))


def label_from_ranges(
    df: DataFrame, code: str, ranges: DataFrame, low: str, high: str, value: str, label: str, default: str
) -> DataFrame:
    """Label of the inclusive whole-number range of a table that holds the code; other codes and NULL get the default.

    Ranges that hold a number twice are an error; those with a NULL end, or that end before they begin, hold none.
    Numbers are dealt into buckets of a fixed width. A range is cut into its piece in the bucket where it begins, its
    piece in the bucket where it ends, and the whole buckets between, which are a range of bucket numbers and are looked
    up by the same means, six times at most. As ranges share no number, a code is held by the piece that begins last
    before it in its bucket or by none, so codes and pieces are shuffled once each, however many ranges there are and
    however long some of them, and a bucket never holds more codes and pieces than its width.
    Distinct codes are looked up, so a frequent code is no hot key there, and then joined to their rows.
    """
    filed = ranges.select(F.col(low).cast("bigint").alias("_low"), F.col(high).cast("bigint").alias("_high"), F.col(value).alias("_value"))
    levels = [filed.where("_low <= _high")]
    while not (inner := _whole_buckets(levels[-1])).isEmpty():
        levels.append(inner)
    twice = _held_twice(levels).orderBy("_code").take(1)
    if twice:
        raise ValueError(f"ranges overlap at {twice[0]['_code']}")
    codes = df.select(F.col(code).cast("bigint").alias("_code")).where("_code IS NOT NULL").distinct()
    joined = df.join(_held(codes, levels), F.col(code).cast("bigint") == F.col("_code"), "left")
    return joined.select(*df.columns, F.coalesce("_value", F.lit(default)).alias(label))


def _bucket(number: str) -> Column:
    return F.shiftright(number, BUCKET_BITS)


def _bucket_start(bucket: str | Column) -> Column:
    return F.shiftleft(bucket, BUCKET_BITS)


def _bucket_end(bucket: str | Column) -> Column:
    return _bucket_start(bucket).bitwiseOR(F.lit((1 << BUCKET_BITS) - 1).cast("bigint"))


def _whole_buckets(ranges: DataFrame) -> DataFrame:
    """The buckets between the ends of each range, as ranges of bucket numbers."""
    inner = ranges.select((_bucket("_low") + 1).alias("_low"), (_bucket("_high") - 1).alias("_high"), "_value")
    return inner.where("_low <= _high")


def _pieces(ranges: DataFrame) -> DataFrame:
    """Each range in the bucket where it begins and in the one where it ends; a piece lies in one bucket."""
    begins = F.struct(F.col("_low"), F.least("_high", _bucket_end(_bucket("_low"))).alias("_high"), "_value")
    ends = F.struct(_bucket_start(_bucket("_high")).alias("_low"), F.col("_high"), "_value")
    apart = _bucket("_low") < _bucket("_high")
    return ranges.select(F.inline(F.when(apart, F.array(begins, ends)).otherwise(F.array(begins))))


def _held(codes: DataFrame, levels: Sequence[DataFrame]) -> DataFrame:
    """The codes, which are distinct, that a range of the first level holds: `_code`, `_value`."""
    pieces = _pieces(levels[0])
    if len(levels) > 1:
        buckets = _held(codes.select(_bucket("_code").alias("_code")).distinct(), levels[1:])
        pieces = pieces.unionByName(buckets.select(_bucket_start("_code").alias("_low"), _bucket_end("_code").alias("_high"), "_value"))
    begins = pieces.select(F.col("_low").alias("_code"), F.struct("_high", "_value").alias("_piece"))
    points = begins.unionByName(codes, allowMissingColumns=True)
    order = Window.partitionBy(_bucket("_code")).orderBy("_code", F.col("_piece").isNull())
    last = F.last("_piece", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = points.withColumn("_last", last).where("_piece IS NULL AND _code <= _last._high")
    return found.select("_code", F.col("_last._value").alias("_value"))


def _held_twice(levels: Sequence[DataFrame]) -> DataFrame:
    """Numbers (`_code`) that two ranges of the first level hold, the smallest among them; no row if there is none."""
    pieces = _pieces(levels[0])
    next_low = F.lead("_low").over(Window.partitionBy(_bucket("_low")).orderBy("_low"))
    twice = pieces.withColumn("_code", next_low).where("_code <= _high").select("_code")
    if len(levels) > 1:
        buckets = pieces.select("_low", _bucket("_low").alias("_code"))
        covered = _held(buckets.select("_code").distinct(), levels[1:])
        twice = twice.unionByName(buckets.join(covered, "_code", "left_semi").select(F.col("_low").alias("_code")))
        twice = twice.unionByName(_held_twice(levels[1:]).select(_bucket_start("_code").alias("_code")))
    return twice


def fold_name(name: Column) -> Column:
    """Lower case without accents, for comparing names."""
    return F.translate(F.lower(name), ACCENTED, UNACCENTED)


def code_of_name(name: Column, book: Mapping[int, str]) -> Column:
    """Code of a name, ignoring case and accents; NULL when the book has no such name."""
    by_name = {plain_name(label): code for code, label in book.items()}
    return F.try_element_at(literal_map(by_name), fold_name(name))


def state_name(code: Column) -> Column:
    return code_label(code, STATE_NAMES, UNKNOWN)


def region_name(code: Column) -> Column:
    return range_label(code, REGIONS, UNKNOWN)


def month_name(month: Column) -> Column:
    """Short month name, or the number as text where there is none."""
    return code_label(month, MONTHS, month.cast("string"))


def lookup_state(code: int) -> str:
    """Accented state name of a single code."""
    return STATE_NAMES_ACCENTED.get(code, UNKNOWN)


def lookup_region(code: int) -> str:
    return next((name for low, high, name in REGIONS if low <= code <= high), UNKNOWN)


def lookup_state_code(name: str) -> int | None:
    wanted = plain_name(name)
    return next((code for code, plain, _ in STATES if plain.lower() == wanted), None)


def plain_name(name: str) -> str:
    return name.lower().translate(str.maketrans(ACCENTED, UNACCENTED))


def literal_map(book: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(book.items())])
