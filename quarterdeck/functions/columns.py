"""Names, text, numbers: the scalar vocabulary shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_of(names: str | Iterable[str] | None) -> list[str]:
    """One name, several names or none, always as a list."""
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def quoted(name: str) -> str:
    """A column name as a reference to that very column, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def clean_names(df: DataFrame) -> DataFrame:
    """Strip the padding around every column name; order is kept."""
    return df.toDF(*(name.strip() for name in df.columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns of ``mapping`` that exist; absent names are no-ops."""
    return df.withColumnsRenamed(dict(mapping))


def trim_text(df: DataFrame, names: str | Iterable[str] | None = None) -> DataFrame:
    """Trim blanks on both ends of the named text columns (all text columns by default).

    Columns of other types are left alone, so a numeric key can be passed safely.
    """
    wanted = columns_of(names) or df.columns
    text = [n for n in wanted if isinstance(df.schema[n].dataType, T.StringType)]
    return df.withColumns({n: F.trim(F.col(quoted(n))) for n in text}) if text else df


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; text that is no such value becomes null, never an error."""
    return df.withColumns({n: F.col(quoted(n)).try_cast(t) for n, t in types.items()})


def series_title(labels: Sequence[str | Column], separator: str = ", ") -> Column:
    """Labels joined by ``separator``. Null parts are skipped, so the title is never
    null: with every label missing it is the empty string."""
    return F.concat_ws(separator, *labels)


def last_segment(path: str | Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def display_number(column: str | Column, places: int = 2) -> Column:
    """Thousands-separated text with a fixed number of decimals."""
    return F.format_number(column, places)


def display_integer(column: str | Column) -> Column:
    """Plain digits without separators, for years."""
    return F.round(column, 0).cast("bigint").cast("string")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number out of several of ``bits`` bits, their bits taken in turn from the lowest up. Sorted by
    it, rows that are near in every one of the numbers stay near."""
    if bits * len(ranks) > 62:
        raise ValueError(f"{len(ranks)} numbers of {bits} bits do not fit into one")
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            place = bit * len(ranks) + i
            own = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(own, place))
    return out
