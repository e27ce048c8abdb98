"""Deeply nested records into related flat tables.

A record is read once into (path, ordinals, value) triples. A path names the keys from the root, with ``[]`` after each list; the ordinals
are the positions in the lists passed. Triples are grouped by their longest path that ends in ``[]`` (the repeated ancestor), which is
found in the data, and each group is pivoted into one table whose key is the record's key and the ordinals; the ordinals without the
last are the key of the parent. The scanner of the standard library reads the text; what is nested deeper than it can follow is read by a
push-down parser of tokens. Walking is by an explicit stack, so depth costs no more than length.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"[ \t\n\r]*(?:([{}\[\],:])"
    r'|"([^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*)"'
    r"|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?![0-9.eE+-])|true|false|null))"
)
BLANK = re.compile(r"[ \t\n\r]*")
SURROGATE = re.compile(r"\\u[dD][89a-fA-F]")
WORDS = {"true": True, "false": False, "null": None}

MEMBER = "{}"  # the column that marks an object as the member of a list
VALUE = "value"  # the column of list members that are neither objects nor lists
Triple = tuple[str, tuple[int, ...], str | None]


class Invalid(ValueError):
    """The text is not one whole, valid JSON value."""


def _refused(word: str) -> None:
    raise Invalid(word)


SCAN = json.JSONDecoder(parse_float=str, parse_int=str, parse_constant=_refused).decode


def _tokens_read(text: str) -> object:
    """The value of a text by tokens and a stack of open containers; numbers stay text."""
    stack: list[tuple[object, str | None]] = []  # open containers, each with the key that waits for its value
    at, expect = 0, "value"
    while True:
        m = TOKEN.match(text, at)
        if m is None:
            raise Invalid
        at = m.end()
        sign = m.group(1)
        if sign and sign in "{[":
            if not expect.startswith("value"):
                raise Invalid
            stack.append(({}, None) if sign == "{" else ([], None))
            expect = "key or end" if sign == "{" else "value or end"
            continue
        if sign == ",":
            if expect != "comma or end":
                raise Invalid
            expect = "key" if isinstance(stack[-1][0], dict) else "value"
            continue
        if sign == ":":
            if expect != "colon":
                raise Invalid
            expect = "value"
            continue
        if sign:
            ends = ("comma or end", "key or end") if sign == "}" else ("comma or end", "value or end")
            if not stack or expect not in ends or isinstance(stack[-1][0], dict) != (sign == "}"):
                raise Invalid
            value = stack.pop()[0]
        elif expect.startswith("key"):
            if m.group(2) is None:
                raise Invalid
            stack[-1] = (stack[-1][0], json.loads(f'"{m.group(2)}"'))
            expect = "colon"
            continue
        elif not expect.startswith("value"):
            raise Invalid
        elif m.group(2) is not None:
            value = json.loads(f'"{m.group(2)}"')
        else:
            value = WORDS.get(m.group(3), m.group(3))
        if not stack:
            if not BLANK.fullmatch(text, at):
                raise Invalid
            return value
        into, key = stack[-1]
        if isinstance(into, dict):
            into[key] = value
        else:
            into.append(value)
        expect = "comma or end"


def read(text: str | None) -> object:
    """The value of one JSON text: objects, lists, text, booleans and None; numbers as their source text. ``Invalid`` if it is none.

    Of a repeated key the last value counts. A text that is a quoted string counts as its content.
    """
    while True:
        if not text:
            raise Invalid
        try:
            value = SCAN(text)
        except RecursionError:
            value = _tokens_read(text)
        except ValueError as e:
            raise Invalid from e
        if not text.lstrip(" \t\n\r").startswith('"'):
            return value
        text = value


def triples(value: object, lone: Collection[str] = ()) -> list[Triple]:
    """The triples of one value. An object in a list, or one alone at a list's path of ``lone``, gives a triple ``path[]{}``, so that
    objects without fields are seen. A list, a lone object there and an empty object give None at their own path.
    """
    out: list[Triple] = []
    add = out.append
    todo: list[tuple[object, str, tuple[int, ...]]] = [(value, "", ())]
    while todo:
        node, base, ords = todo.pop()
        if type(node) is dict:
            dot = base + "." if base else ""
            for k, v in node.items():
                path = dot + k
                t = type(v)
                if t is str:
                    add((path, ords, v))
                elif t is list or (t is dict and (path in lone or not v)):
                    add((path, ords, None))
                    if path in lone and t is dict:
                        v = [v]
                    todo.append((v, path, ords))
                elif t is dict:
                    todo.append((v, path, ords))
                else:
                    add((path, ords, None if v is None else "true" if v else "false"))
        elif type(node) is list:
            path = base + "[]"
            for i, v in enumerate(node):
                t = type(v)
                if t is dict:
                    add((path + MEMBER, (*ords, i), None))
                    todo.append((v, path, (*ords, i)))
                elif t is list:
                    todo.append((v, path, (*ords, i)))
                else:
                    add((path, (*ords, i), v if t is str else None if v is None else "true" if v else "false"))
    return out


def pivot(found: Sequence[Triple], split: dict[str, tuple[str, str]] | None = None) -> dict[tuple[str, tuple[int, ...]], dict[str, str | None]]:
    """Rows by (repeated path, ordinals): the triples whose longest ``[]`` prefix is that path, turned into columns. ``split`` keeps known paths."""
    rows: dict[tuple[str, tuple[int, ...]], dict[str, str | None]] = {("", ()): {}}
    split = {} if split is None else split
    base, row, of = "", rows["", ()], ()
    for path, ords, value in found:
        pair = split.get(path)
        if pair is None:
            cut = path.rfind("[]")
            pair = split[path] = (path[: cut + 2] if cut >= 0 else "", (path[cut + 2 :].lstrip(".") or VALUE) if cut >= 0 else path)
        if ords is not of or pair[0] != base:
            base, of = pair[0], ords
            key = (base, ords)
            row = rows.get(key)
            if row is None:
                row = rows[key] = {}
        row[pair[1]] = value
    return rows


def _whole(fields: dict[str, str | None]) -> dict[str, str | None]:
    """Lone surrogates replaced."""
    fix = lambda s: s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return {fix(k): v if v is None else fix(v) for k, v in fields.items()}


PARTS = "path string, ordinals array<int>, is_object boolean, fields map<string,string>, parent map<string,string>"
RECORDS = f"record_key bigint, record_time bigint, copy bigint, parts array<struct<{PARTS.replace(' ', ': ').replace(',: ', ', ')}>>"
ARROW_MAP = pa.map_(pa.string(), pa.string())


def _maps(rows: list[dict[str, str | None] | None]) -> pa.Array:
    keys: list[str] = []
    values: list[str | None] = []
    size = np.zeros(len(rows) + 1, dtype=np.int32)
    for i, r in enumerate(rows):
        if r:
            keys.extend(r)
            values.extend(r.values())
            size[i + 1] = len(r)
    return pa.MapArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(keys, pa.string()), pa.array(values, pa.string()))


def _lists(rows: list[tuple[int, ...]]) -> pa.Array:
    size = np.fromiter(map(len, rows), dtype=np.int32, count=len(rows))
    flat = np.fromiter((x for r in rows for x in r), dtype=np.int32, count=int(size.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))


def records(df: DataFrame, key: str, body: str, lone: Sequence[str] = (), time: str | None = None, paths: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each valid record: key, time, ``copy`` (a hash of the text) and ``parts``, the rows of all its tables.

    A part has its repeated path ('' for the record itself), ordinals, own fields, and the fields of the nearest repeated ancestor.
    ``lone`` are paths of lists at which a lone object is a list of one. Members of a list that are no objects have ``is_object`` false
    and the one field ``value``. ``paths`` and ``columns`` name what is wanted, if not all. Null, empty and invalid texts give nothing.
    """
    lone, want, cols = frozenset(lone), None if paths is None else frozenset(paths), None if columns is None else tuple(columns)
    at = F.unix_micros(F.col(time).cast("timestamp")) if time else F.lit(None).cast("bigint")
    rows = df.select(F.col(key).cast("bigint").alias("record_key"), at.alias("record_time"), F.xxhash64(body).alias("copy"), F.col(body).alias("body")).where("body is not null and body <> ''")

    def parse(batches):
        split: dict[str, tuple[str, str]] = {}
        for batch in batches:
            if len(split) > 100_000:  # paths that never end, such as keys that are values
                split.clear()
            kept, count, path_of, ord_of, is_object, own, up = [], [], [], [], [], [], []
            for n, text in enumerate(batch.column(3).to_pylist()):
                try:
                    tables = pivot(triples(read(text), lone), split)
                except Invalid:
                    continue
                broken = SURROGATE.search(text) is not None
                before = len(path_of)
                for (path, ords), row in tables.items():
                    if want is not None and path not in want:
                        continue
                    above, depth = path[:-2].rfind("[]"), len(ords)
                    parent = tables.get((path[: above + 2], ords[: depth - 1])) if above >= 0 else tables["", ()] if path else None
                    is_object.append(VALUE not in row or MEMBER in row or not path)
                    mine = {k: v for k, v in row.items() if k != MEMBER} if cols is None else {c: row[c] for c in cols if c in row}
                    theirs = {k: v for k, v in parent.items() if k != MEMBER} if parent and cols is None else {c: parent[c] for c in cols if c in parent} if parent else {}
                    path_of.append(path)
                    ord_of.append(ords)
                    own.append(_whole(mine) if broken else mine)
                    up.append(_whole(theirs) if broken else theirs)
                kept.append(n)
                count.append(len(path_of) - before)
            if kept:
                parts = pa.StructArray.from_arrays([pa.array(path_of, pa.string()), _lists(ord_of), pa.array(is_object, pa.bool_()), _maps(own), _maps(up)], ["path", "ordinals", "is_object", "fields", "parent"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), parts)
                some = pa.array(kept)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(some) for i in range(3)), lists], ["record_key", "record_time", "copy", "parts"])

    return rows.mapInArrow(parse, RECORDS)


def once_each(found: DataFrame) -> DataFrame:
    """One of the copies of each record key: the first by time, then by its text. Records without a key are no copies of each other."""
    apart = F.when(F.col("record_key").isNull(), F.monotonically_increasing_id())
    return found.groupBy("record_key", apart.alias("apart")).agg(F.min_by(F.struct("record_time", "parts"), F.struct("record_time", "copy")).alias("r")).select("record_key", "r.*")


def record_rows(df: DataFrame, key: str, body: str, lone: Sequence[str] = (), time: str | None = None, once: bool = False, **wanted: Sequence[str] | None) -> DataFrame:
    """All rows of all tables of all records (see ``records``); with ``once`` the copies of a record count once. Without it nothing is shuffled."""
    found = records(df, key, body, lone, time, **wanted)
    found = once_each(found) if once else found
    return found.select("record_key", "record_time", F.inline("parts"))
