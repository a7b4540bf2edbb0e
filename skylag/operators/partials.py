"""Mergeable partial results of numeric columns, several kinds in one scan.

A task keeps one small numpy state per group and kind (moments, bins, curve
points, rank buckets, whiskers), adds every Arrow batch to it and hands out a
bounded number of rows at its end; a plain aggregate merges the rows of all
tasks. So no row is exploded or unpivoted, and one scan can feed many tables.

The settings of a pass (bin edges, bandwidths, open intervals: a few numbers
per group and column) travel with the function if they are few. Otherwise they
are a table that joins the rows by group, so groups may be as many as they like.
Missing values are NULL or NaN and take no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HELD_GROUPS = 256  # states kept by a task; they are handed out and begun anew beyond that
_FIELDS = (("n", pa.int64()), *((c, pa.float64()) for c in ("x", "y", "xx", "xy", "low", "high")))
# exp(-0.5 * 39 * 39) is zero in double precision.
_KERNEL_REACH = 39.0
_SERIES_SPACING = 2.0  # bandwidths between grid points


def wide(df: DataFrame, columns: Sequence[str] | dict[str, Column], by: str | None = None) -> DataFrame:
    """The group as ``g`` and the values as doubles ``c0``, ``c1`` ..., the form all passes read."""
    values = columns.values() if isinstance(columns, dict) else [F.col(c) for c in columns]
    key = [F.col(by).alias("g")] if by else []
    return df.select(*key, *[v.cast("double").alias(f"c{i}") for i, v in enumerate(values)])


@dataclass(frozen=True)
class Derived:
    """Rows in the form of :func:`wide` of which some columns are made within the tasks: a value handed to Python costs more.

    ``made``: the number of such a column, the columns of ``rows`` it is made of, and a function of
    the number of rows and, for each of them, its values and where they are NULL.
    """

    rows: DataFrame
    made: dict[int, tuple[tuple[str, ...], Callable[..., np.ndarray]]]


class _Moments:
    """Counts, means and centred sums of squares and products, merged batch by batch.

    With ``pairs`` for every two columns over the rows in which both are known;
    settings (column), by default all.
    """

    def __init__(self, settings: list[tuple] | None, width: int, pairs: bool):
        self.pairs = pairs
        self.at = np.array([int(s[0]) for s in settings], np.int64) if settings else None
        width = width if self.at is None else len(self.at)
        shape = (width, width) if pairs else (width,)
        self.n, self.x, self.xx, self.xy = (np.zeros(shape) for _ in range(4))
        self.low, self.high = np.full(width, np.inf), np.full(width, -np.inf)

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        if self.at is not None:
            values, known = values[:, self.at], known[:, self.at]
        if not self.pairs:
            self._add_singly(values, known)
            return
        m = known.astype(np.float64)
        count = m.sum(axis=0)
        shift = np.divide(np.where(known, values, 0.0).sum(axis=0), count, out=np.zeros(len(count)), where=count > 0)
        v = np.where(known, values - shift, 0.0)
        self.low = np.minimum(self.low, np.where(known, values, np.inf).min(axis=0, initial=np.inf))
        self.high = np.maximum(self.high, np.where(known, values, -np.inf).max(axis=0, initial=-np.inf))
        n, s, q, p = m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v
        safe = np.maximum(n, 1.0)
        self._merge(n, shift[:, None] + s / safe, q - s * s / safe, p - s * s.T / safe)

    def _add_singly(self, values: np.ndarray, known: np.ndarray) -> None:
        """Column by column over what is known, without copies of the whole batch."""
        n, x, xx = (np.zeros(len(self.low)) for _ in range(3))
        for i in range(len(self.low)):
            v = values[known[:, i], i]
            if not len(v):
                continue
            shift = v.sum() / len(v)
            self.low[i], self.high[i] = min(self.low[i], v.min()), max(self.high[i], v.max())
            v = v - shift
            s = v.sum()
            n[i], x[i], xx[i] = len(v), shift + s / len(v), v @ v - s * s / len(v)
        self._merge(n, x, xx, xx)

    def _merge(self, n, x, xx, xy) -> None:
        total = np.maximum(self.n + n, 1.0)
        step = np.where(n > 0, x - self.x, 0.0)
        share = self.n * n / total
        self.xx += np.where(n > 0, xx, 0.0) + step * step * share
        self.xy += np.where(n > 0, xy, 0.0) + step * step.T * share
        self.x += step * n / total
        self.n += n

    def rows(self) -> dict:
        i, *j = np.nonzero(self.n)
        at = (i, *j)
        one = i if not j else np.where(i == j[0], i, -1)
        name = np.arange(len(self.low)) if self.at is None else self.at
        return {
            "i": name[i], "j": name[j[0] if j else i], "n": self.n[at].astype(np.int64), "x": self.x[at], "y": self.x.T[at], "xx": self.xx[at],
            "xy": self.xy[at], "low": np.where(one >= 0, self.low[one], np.nan), "high": np.where(one >= 0, self.high[one], np.nan),
        }


class _Bins:
    """Rows per equal-width bin; settings (column, first edge, width)."""

    def __init__(self, settings: list[tuple], width: int, bins: int):
        self.edges = [(int(s[0]), s[1], s[2]) for s in settings]
        self.counts = np.zeros((len(self.edges), bins), np.int64)

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        bins = self.counts.shape[1]
        for k, (i, low, width) in enumerate(self.edges):
            place = np.floor((values[known[:, i], i] - low) / width)
            self.counts[k] += np.bincount(np.clip(place, 0, bins - 1).astype(np.int64), minlength=bins)

    def rows(self) -> dict:
        k, j = np.nonzero(self.counts)
        return {"i": np.array([e[0] for e in self.edges], np.int64)[k], "j": j, "n": self.counts[k, j]}


def _series_terms(spacing: float) -> int:
    """Terms of exp(x * d) that leave errors below 1e-18 of a kernel's height; 0 on grids too coarse for a series.

    d is at most half a spacing. The error at x, x^T d^T e^(x d) / T!, counts
    as much as the kernel there, exp(-x * x / 2), lets it.
    """
    if not spacing <= _SERIES_SPACING:
        return 0
    half = spacing / 2
    for terms in range(4, 200):
        x = half / 2 + math.sqrt(half * half / 4 + terms)  # where the error is largest
        if terms * math.log(x * max(half, 1e-300)) + x * half - x * x / 2 - math.lgamma(terms + 1) < -42:
            return terms
    return 0


class _Curves:
    """Kernel sums at an even grid; settings (column, first point, step, bandwidth).

    A value d bandwidths from its nearest grid point adds, x bandwidths from
    that point, exp(-x^2/2) exp(-d^2/2) exp(x d). The last factor's series
    parts x from d, so a task keeps sums of exp(-d^2/2) d^t per grid point, one
    exponential and a few products per value, and makes curve sums of them at
    its end. On a coarse grid the few points in reach are summed one by one.
    """

    def __init__(self, settings: list[tuple] | None, width: int, grid: int):
        self.grid = grid
        self.curves = [(int(s[0]), s[1], s[2], s[2] / s[3], _series_terms(s[2] / s[3])) for s in settings or ()]
        self.sums = [np.zeros((max(1, c[4]), grid)) for c in self.curves]

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        for (i, low, step, spacing, terms), sums in zip(self.curves, self.sums):
            place = (values[known[:, i], i] - low) / step
            nearest = np.clip(np.rint(place), 0, self.grid - 1).astype(np.int64)
            away = (place - nearest) * spacing
            if terms:
                part = np.exp(-0.5 * away * away)
                for t in range(terms):
                    sums[t] += np.bincount(nearest, part, self.grid)
                    part *= away
                continue
            reach = min(self.grid, math.ceil(_KERNEL_REACH / spacing) + 1)
            for k in range(-reach, reach + 1):
                inside = (nearest + k >= 0) & (nearest + k < self.grid)
                x = k * spacing - away[inside]
                sums[0] += np.bincount(nearest[inside] + k, np.exp(-0.5 * x * x), self.grid)

    def rows(self) -> dict:
        out = np.zeros((len(self.curves), self.grid))
        for k, ((_, _, _, spacing, terms), sums) in enumerate(zip(self.curves, self.sums)):
            if not terms:
                out[k] = sums[0]
                continue
            x = (np.arange(self.grid)[:, None] - np.arange(self.grid)[None, :]) * spacing
            weight = np.exp(-0.5 * x * x)
            for t in range(terms):
                out[k] += weight @ sums[t]
                weight *= x / (t + 1)
        out = np.maximum(out, 0.0)
        k, j = np.nonzero(out)
        return {"i": np.array([c[0] for c in self.curves], np.int64)[k], "j": j, "x": out[k, j]}


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


class _Ranks:
    """Radix buckets of open intervals; settings (column, lowest value, highest value), by default all of every column.

    The differing leading bits of the interval's ordered keys choose the
    bucket; ``singly`` gives every value a bucket of its own. A bucket tells
    its count and its extreme values, so that one of equal values is settled.
    """

    def __init__(self, settings: list[tuple], width: int, buckets: int, singly: bool):
        self.singly, bits = singly, max(1, (buckets - 1).bit_length())
        self.open = []
        for s in settings or [(i, -np.inf, np.inf) for i in range(width)]:
            low, high = (int(k) for k in ordered_keys(np.array([s[1], s[2]], np.float64)))
            self.open.append((int(s[0]), s[1], s[2], low, 0 if singly else max(0, (high - low).bit_length() - bits)))
        size = 0 if singly else 1 << bits
        self.counts = np.zeros((len(self.open), size), np.int64)
        self.low, self.high = np.full((len(self.open), size), np.inf), np.full((len(self.open), size), -np.inf)
        self.single: list[list[np.ndarray]] = [[] for _ in self.open]

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        for k, (i, low, high, least, shift) in enumerate(self.open):
            column = values[:, i]
            inside = np.sort(column[(column >= low) & (column <= high)])
            if not len(inside):
                continue
            if self.singly:
                self.single[k].append(inside)
                continue
            keys = ordered_keys(inside)
            bucket = ((keys.view(np.uint64) - np.uint64(least & (1 << 64) - 1)) >> np.uint64(shift)).view(np.int64)
            first = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1])
            last = np.append(first[1:], len(bucket))
            j = bucket[first]
            self.counts[k, j] += last - first
            self.low[k, j] = np.minimum(self.low[k, j], inside[first])
            self.high[k, j] = np.maximum(self.high[k, j], inside[last - 1])

    def rows(self) -> dict:
        if not self.singly:
            k, j = np.nonzero(self.counts)
            n, low, high = self.counts[k, j], self.low[k, j], self.high[k, j]
        else:  # few values in all
            found = [np.unique(np.concatenate([*one, np.empty(0)]), return_counts=True) for one in self.single]
            k = np.repeat(np.arange(len(found)), [len(v) for v, _ in found])
            low = high = np.concatenate([*[v for v, _ in found], np.empty(0)])
            n, j = np.concatenate([*[c for _, c in found], np.empty(0, np.int64)]), ordered_keys(low)
        i, x = np.array([o[0] for o in self.open], np.int64), np.array([o[1] for o in self.open], np.float64)
        return {"i": i[k], "j": j, "n": n, "x": x[k], "low": low, "high": high}


class _Whiskers:
    """Extreme values inside two fences and the count beyond them; settings (column, low fence, high fence)."""

    def __init__(self, settings: list[tuple], width: int):
        self.fences = [(int(s[0]), s[1], s[2]) for s in settings]
        self.held = [[0, np.inf, -np.inf] for _ in self.fences]

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        for (i, low, high), held in zip(self.fences, self.held):
            v = values[known[:, i], i]
            held[0] += int(((v < low) | (v > high)).sum())
            held[1] = min(held[1], v[v >= low].min(initial=np.inf))
            held[2] = max(held[2], v[v <= high].max(initial=-np.inf))

    def rows(self) -> dict:
        i = np.array([f[0] for f in self.fences], np.int64)
        n, low, high = zip(*self.held) if self.held else ((),) * 3
        return {"i": i, "j": np.zeros(len(i), np.int64), "n": np.array(n, np.int64), "low": low, "high": high}


_STATES = {"moments": _Moments, "bins": _Bins, "curves": _Curves, "ranks": _Ranks, "whiskers": _Whiskers}


@dataclass(frozen=True)
class Part:
    """One kind of partial result.

    ``settings`` are rows of the column's number and up to three doubles, or
    such lists by group. None: the kind needs none, or they come as a table.
    ``name`` tells two parts of one kind in one scan apart.
    """

    kind: str
    options: dict
    settings: Sequence[tuple] | dict | None = None
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def moments(pairs: bool = False) -> Part:
    return Part("moments", {"pairs": pairs})


def moments_among(columns: Sequence[int], name: str) -> Part:
    """Pair moments of these columns only."""
    return Part("moments", {"pairs": True}, [(i,) for i in columns], name)


def _handed_out(states: dict, kinds: Sequence[str], group: pa.DataType | None) -> Iterable[pa.RecordBatch]:
    for place, kind in enumerate(kinds):
        parts = [(g, own[place].rows()) for g, own in states.items() if own[place] is not None]
        sizes = [len(p["i"]) for _, p in parts]
        if not sum(sizes):
            continue
        columns = {"kind": pa.array([kind] * sum(sizes), pa.string())}
        if group is not None:
            columns["g"] = pa.array([g for (g, _), n in zip(parts, sizes) for _ in range(n)], group)
        columns["i"] = pa.array(np.concatenate([p["i"] for _, p in parts]), pa.int32())
        columns["j"] = pa.array(np.concatenate([p["j"] for _, p in parts]), pa.int64())
        for name, type_ in _FIELDS:
            if name in parts[0][1]:
                columns[name] = pa.array(np.concatenate([np.asarray(p[name]) for _, p in parts]), type_)
            else:
                columns[name] = pa.nulls(sum(sizes), type_)
        yield pa.RecordBatch.from_pydict(columns)


def sweep(rows: DataFrame | Derived, *parts: Part, settings: DataFrame | None = None) -> DataFrame:
    """Partial results of all tasks over rows in the form of :func:`wide`, not merged yet.

    Columns kind, g (with groups), i (column), j (place), n, x, y, xx, xy, low,
    high. ``settings`` may hold those of many groups as (g, kind, i, a, b, c).
    Groups without settings are passed over, columns that none names are not read.
    """
    rows, made = (rows.rows, rows.made) if isinstance(rows, Derived) else (rows, {})
    grouped = "g" in rows.columns
    width = sum(c.startswith("c") for c in rows.columns) + len(made)
    kinds = [p.label for p in parts]
    joined = settings is not None
    used = list(range(width))
    if not joined and all(p.settings is not None for p in parts):
        given = [p.settings if isinstance(p.settings, list) else [s for own in p.settings.values() for s in own] for p in parts]
        used = sorted({int(s[0]) for own in given for s in own})
    plain, made = [i for i in used if i not in made], {i: made[i] for i in used if i in made}
    sources = sorted({c for names, _ in made.values() for c in names})
    rows = rows.select(*(["g"] if grouped else []), *dict.fromkeys([*[f"c{i}" for i in plain], *sources]))
    if joined:
        listed = settings.groupBy("g").agg(F.collect_list(F.struct("kind", "i", "a", "b", "c")).alias("settings"))
        rows = rows.alias("r").join(listed.alias("s"), F.col("r.g").eqNullSafe(F.col("s.g"))).select("r.*", "s.settings")

    def begun(key, own: list[dict] | None):
        out = []
        for p in parts:
            if own is not None:
                chosen = [(s["i"], s["a"], s["b"], s["c"]) for s in own if s["kind"] == p.label]
            elif isinstance(p.settings, dict):
                chosen = p.settings.get(key)
            else:
                chosen = p.settings
            out.append(_STATES[p.kind](chosen, width, **p.options) if chosen or p.settings is None else None)
        return out

    def run(batches):
        states: dict = {}
        group = None
        with np.errstate(all="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                values = np.full((batch.num_rows, width), np.nan, order="F")
                for i in plain:
                    values[:, i] = batch.column(f"c{i}").to_numpy(zero_copy_only=False)
                read = {c: (batch.column(c).to_numpy(zero_copy_only=False), batch.column(c).is_null().to_numpy(zero_copy_only=False)) for c in sources}
                for i, (names, make) in made.items():
                    values[:, i] = make(batch.num_rows, *[read[c] for c in names])
                known = ~np.isnan(values)
                if grouped:
                    group = batch.column("g").type
                    coded = batch.column("g").dictionary_encode(null_encoding="encode")
                    codes, keys = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                    order = np.argsort(codes, kind="stable")
                    bounds = np.searchsorted(codes[order], np.arange(len(keys) + 1))
                else:
                    keys, order, bounds = [None], None, None
                for k, key in enumerate(keys):
                    at = slice(None) if order is None else order[bounds[k] : bounds[k + 1]]
                    if key not in states:
                        if len(states) >= HELD_GROUPS:
                            yield from _handed_out(states, kinds, group)
                            states = {}
                        states[key] = begun(key, batch.column("settings")[int(at[0])].as_py() if joined else None)
                    for state in states[key]:
                        if state is not None:
                            state.add(values[at], known[at])
            yield from _handed_out(states, kinds, group)

    g = f"g {rows.schema['g'].dataType.simpleString()}, " if grouped else ""
    schema = f"kind string, {g}i int, j bigint, n bigint, x double, y double, xx double, xy double, low double, high double"
    return rows.mapInArrow(run, schema)


def _keys(partials: DataFrame) -> list[str]:
    return [c for c in ("g", "i", "j") if c in partials.columns]


def merged_moments(partials: DataFrame) -> DataFrame:
    """One row per group and pair of columns: n, x, y (means), xx, xy (centred sums), low, high.

    Means first, then every task's sums are moved to the common means: nothing
    is lost to cancellation however far the values are from zero.
    """
    over = Window.partitionBy(*_keys(partials))
    total = F.sum("n").over(over)
    rows = partials.where(F.col("kind") == "moments").withColumns(
        {"mx": F.sum(F.col("n") * F.col("x")).over(over) / total, "my": F.sum(F.col("n") * F.col("y")).over(over) / total}
    )
    away_x, away_y = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    return rows.groupBy(*_keys(partials)).agg(
        F.sum("n").alias("n"),
        F.first("mx").alias("x"),
        F.first("my").alias("y"),
        F.sum(F.col("xx") + F.col("n") * away_x * away_x).alias("xx"),
        F.sum(F.col("xy") + F.col("n") * away_x * away_y).alias("xy"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def merged(partials: DataFrame, kind: str, *more: str) -> DataFrame:
    """Counts and kernel sums added, extremes kept, per group, column and place."""
    return partials.where(F.col("kind") == kind).groupBy(*_keys(partials), *more).agg(
        F.sum("n").alias("n"), *([] if "x" in more else [F.sum("x").alias("x")]), F.min("low").alias("low"), F.max("high").alias("high")
    )
