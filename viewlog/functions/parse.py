"""Parsing of one Python dict literal per text line.

This is the only place the log pipeline runs Python per row: a literal can
hold any Python value (``None``, tuples, nested dicts, ``1.50``) whose text
form must be Python's ``str()``, which no JVM JSON reader reproduces. Arrow
batches of lines go to the Python worker; ingest gets plain string columns
back, only column discovery gets the whole record as a map.

Most log lines are flat: quoted keys, quoted strings, ``None`` and short plain
numbers. Those are read by one regular expression; anything else (escapes,
nesting, long numbers, other literal forms) goes to ``ast.literal_eval``. A
line that is no dict literal, or whose values have no text form, is dropped.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.session import ship_package

# A quoted string without backslashes, line ends, NUL or its own quote inside.
_STR = r"""'[^'\\\n\r\0]*'|"[^"\\\n\r\0]*\""""
# Plain int (no leading zeros, no underscores) or decimal float, optional sign, of bounded length.
_NUM = r"[-+]?(?:0|[1-9][0-9]{0,99})(?:\.[0-9]{1,99})?"
_VALUE = rf"(?:{_STR}|None|True|False|{_NUM})"
_PAIR = rf"[ \t]*(?:{_STR})[ \t]*:[ \t]*{_VALUE}[ \t]*"
_FLAT = re.compile(rf"\{{(?:{_PAIR}(?:,{_PAIR})*,?)?[ \t]*\}}")
_PAIRS = re.compile(rf"({_STR})[ \t]*:[ \t]*({_VALUE})")

#: Pairs up to which flat records have a pattern of their own number of pairs, and the key tuples whose columns are remembered.
MAX_PAIRS = 64
MAX_LAYOUTS = 4096


@lru_cache(MAX_PAIRS)
def _flat_of(n: int) -> re.Pattern[str]:
    """``_FLAT`` of ``n`` pairs, with every key and value as a group."""
    pair = rf"[ \t]*({_STR})[ \t]*:[ \t]*({_VALUE})[ \t]*"
    return re.compile(rf"\{{{','.join([pair] * n)},?[ \t]*\}}")


def _fast_value(tok: str) -> str | None:
    if tok[0] in "'\"":
        return tok[1:-1]
    if tok == "None":
        return None
    if tok in ("True", "False"):
        return tok
    return str(float(tok)) if "." in tok else str(int(tok))


#: Why a line is rejected.
EMPTY, NO_LITERAL, NO_DICT, NO_TEXT, NO_KEY = "empty", "not a literal", "not a dict", "value without text", "no required key"


def judge(line: str | None) -> tuple[dict[str, str | None] | None, str | None]:
    """One line -> ({key: str(value) or None}, None), or (None, why it is no such record)."""
    text = line.strip() if line is not None else ""
    if not text:
        return None, EMPTY
    if _FLAT.fullmatch(text):
        return {k[1:-1]: _fast_value(v) for k, v in _PAIRS.findall(text)}, None
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None, NO_LITERAL
    if not isinstance(value, dict):
        return None, NO_DICT
    try:
        out = {str(k): (None if v is None else str(v)) for k, v in value.items()}
        # Text that has no UTF-8 form (lone surrogates) cannot be a column value.
        "".join(x for kv in out.items() for x in kv if x is not None).encode()
        return out, None
    except (ValueError, TypeError, MemoryError, RecursionError):
        return None, NO_TEXT


def parse_dict_literal(line: str | None) -> dict[str, str | None] | None:
    """One line -> {key: str(value) or None}, or None if not a dict literal."""
    return judge(line)[0]


def _map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.map_(pa.string(), pa.string())
    for batch in batches:
        records = (parse_dict_literal(line) for line in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([None if r is None else list(r.items()) for r in records], kind)], names=["rec"])


class _Rows:
    """Lines as rows of columns; what the keys of a flat record mean for the columns is looked up by their tuple.

    Neighbouring lines mostly have the same number of pairs, so a line is first
    read with the pattern that fitted the one before; any other goes to ``judge``.
    """

    def __init__(self, spellings: dict[str, list[str]], required: tuple[str, ...]) -> None:
        self.spellings, self.required = list(spellings.values()), required
        self.pattern = _flat_of(1)
        self.layouts: dict[tuple[str, ...], list[tuple[int, ...]] | None] = {}

    def _layout(self, keys: tuple[str, ...]) -> list[tuple[int, ...]] | None:
        """For each column the places of its spellings among the quoted ``keys``, None without a required key."""
        place = {k[1:-1]: i for i, k in enumerate(keys)}  # the last of equal keys, as in a dict
        if not any(k in place for k in self.required):
            return None
        return [tuple(place[k] for k in names if k in place) for names in self.spellings]

    def __call__(self, line: str | None) -> tuple[list[str | None] | None, str | None]:
        """(column values, None), or (None, why the line is rejected)."""
        found = self.pattern.fullmatch(line.strip()) if line is not None else None
        if found is None:
            record, reason = judge(line)
            if record is None:
                return None, reason
            if 0 < len(record) <= MAX_PAIRS:
                self.pattern = _flat_of(len(record))
            if not any(k in record for k in self.required):
                return None, NO_KEY
            return [next((v for k in names if (v := record.get(k)) is not None), None) for names in self.spellings], None
        tokens = found.groups()
        keys, values = tokens[::2], tokens[1::2]
        try:
            layout = self.layouts[keys]
        except KeyError:
            layout = self._layout(keys)
            if len(self.layouts) < MAX_LAYOUTS:
                self.layouts[keys] = layout
        if layout is None:
            return None, NO_KEY
        row: list[str | None] = []
        for places in layout:
            value = None
            for i in places:
                token = values[i]
                value = token[1:-1] if token[0] in "'\"" else _fast_value(token)
                if value is not None:
                    break
            row.append(value)
        return row, None


def _columns(rows: list[list[str | None]], names: list[str]) -> list[pa.Array]:
    return [pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * len(names)


def _column_batches(batches: Iterator[pa.RecordBatch], spellings: dict[str, list[str]], required: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    read = _Rows(spellings, required)
    for batch in batches:
        rows = [row for line in batch.column(0).to_pylist() if (row := read(line)[0]) is not None]
        yield pa.RecordBatch.from_arrays(_columns(rows, list(spellings)), names=list(spellings))


def _judged_batches(batches: Iterator[pa.RecordBatch], spellings: dict[str, list[str]], required: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    read, names, none = _Rows(spellings, required), [*spellings, "reject_reason", "line"], [None] * len(spellings)
    for batch in batches:
        rows = []
        for line in batch.column(0).to_pylist():
            row, reason = read(line)
            rows.append([*row, None, None] if row is not None else [*none, reason, line])
        yield pa.RecordBatch.from_arrays(_columns(rows, names), names=names)


def parse_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """One ``rec`` MAP<STRING,STRING> per line (NULL if not a dict literal).

    The operator is opaque to the optimizer, so filters on ``rec`` stay above
    it and every line is parsed exactly once.
    """
    ship_package(lines.sparkSession)
    return lines.select(F.col(col).cast("string")).mapInArrow(_map_batches, "rec map<string,string>")


def parse_columns(lines: DataFrame, spellings: dict[str, list[str]], required: tuple[str, ...], col: str = "value") -> DataFrame:
    """One row per dict literal with a ``required`` key: a STRING column for each entry of ``spellings``.

    A column's value is the first of its spellings that is present and not
    None. Only these columns travel back, not the whole record.
    """
    ship_package(lines.sparkSession)
    schema = ", ".join(f"`{c}` string" for c in spellings)
    run = partial(_column_batches, spellings=spellings, required=tuple(required))
    return lines.select(F.col(col).cast("string")).mapInArrow(run, schema)


def parse_judged(lines: DataFrame, spellings: dict[str, list[str]], required: tuple[str, ...], col: str = "value") -> DataFrame:
    """``parse_columns`` with every line kept: a rejected one has NULL columns, its ``reject_reason`` and the ``line`` itself."""
    ship_package(lines.sparkSession)
    schema = ", ".join(f"`{c}` string" for c in (*spellings, "reject_reason", "line"))
    run = partial(_judged_batches, spellings=spellings, required=tuple(required))
    return lines.select(F.col(col).cast("string")).mapInArrow(run, schema)
