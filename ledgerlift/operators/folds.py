"""Folds over the boxes of many documents at once, for Arrow batches in which a document is one row.

A step of the fold is one numpy operation over all documents of a batch that are that long; the arithmetic of each
document is that of `receipts.cluster_1d`.
"""

from __future__ import annotations

import itertools
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _ordered(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places in the order of doc, then of the keys; missing values, which are masked, come first and NaN last."""
    flat = [k for key in keys for k in ((~np.ma.getmaskarray(key), np.ma.getdata(key)) if isinstance(key, np.ma.MaskedArray) else (key,))]
    return np.lexsort([*flat[::-1], doc])


def clusters(values: np.ndarray, sizes: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The cluster of each value, documents (of `sizes` values) one after another: a value joins the current cluster if it is
    at most its document's `gap` above the cluster's running mean. Missing values are masked."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = _ordered(doc, values, np.arange(len(values)))
    v = np.ma.filled(values, np.nan)[order]
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    long = np.sort(sizes)
    centre, n, k = np.zeros(len(sizes)), np.zeros(len(sizes)), np.full(len(sizes), -1)
    out = np.zeros(len(values), np.int32)
    for step in range(int(sizes.max(initial=0))):
        at = by_size[: len(sizes) - np.searchsorted(long, step, "right")]  # documents with a value at this place
        p, c = v[start[at] + step], centre[at]
        joins = (n[at] > 0) & (p - c <= gap[at])
        k[at] += ~joins
        centre[at] = np.where(joins, c + (p - c) / (n[at] + 1), p)
        n[at] = np.where(joins, n[at] + 1, 1)
        out[order[start[at] + step]] = k[at]
    return out


def pitches(cols: np.ndarray, cy: np.ma.MaskedArray, sizes: np.ndarray) -> np.ndarray:
    """By document, the upper median of the steps from a box to the next one below it in its column; 0 without any."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = _ordered(doc, cols, cy, np.arange(len(doc)))
    d, c, y = doc[order], cols[order], cy[order]
    step = y[1:] - y[:-1]
    same = (d[1:] == d[:-1]) & (c[1:] == c[:-1]) & ~np.ma.getmaskarray(step)
    step, d = np.ma.getdata(step)[same], d[1:][same]
    step = step[np.lexsort([step, d])]
    many = np.bincount(d, minlength=len(sizes))
    first = np.cumsum(many) - many
    out = np.zeros(len(sizes))
    out[many > 0] = step[(first + many // 2)[many > 0]]
    return out


def _masked(column: pa.Array) -> np.ma.MaskedArray:
    return np.ma.masked_array(pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False))


def _laid(cx: pa.Array, cy: pa.Array, gap_x: pa.Array, gap_y: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column by box, row by box, pitch by document) from lists of box centres.

    gap_y holds for rows where no column has a pitch; half the pitch does otherwise.
    """
    x, y = _masked(cx.flatten()), _masked(cy.flatten())
    cols = clusters(x, sizes, np.ma.filled(_masked(gap_x), np.nan))
    pitch = pitches(cols, y, sizes)
    return cols, clusters(y, sizes, np.where(pitch > 0, pitch / 2, np.ma.filled(_masked(gap_y), np.nan))), pitch


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _flags(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(bool)


def _listed(sizes: np.ndarray, values: pa.Array | np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Lists of `sizes` values, one after another."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values if kind is None else pa.array(values, kind))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def laid_out(cx: pa.Array, cy: pa.Array, gap_x: pa.Array, gap_y: pa.Array) -> pa.Array:
    """struct(cols, rows, pitch) by document, the first two by box, from lists of box centres."""
    sizes = _sizes(cx)
    cols, rows, pitch = _laid(cx, cy, gap_x, gap_y, sizes)
    return pa.StructArray.from_arrays([_listed(sizes, cols, pa.int32()), _listed(sizes, rows, pa.int32()), pa.array(pitch, pa.float64())], ["cols", "rows", "pitch"])


def gridded(box_idx: pa.Array, cx: pa.Array, cy: pa.Array, gap_x: pa.Array, gap_y: pa.Array, text: pa.Array, digits: pa.Array, number: pa.Array, digit: pa.Array, conf: pa.Array) -> pa.Array:
    """struct(cols, at, text, digits, columns, rows) by document, from lists by box, in the order of box_idx.

    cols: the column of each box. at: row x number of columns + column of each cell, ascending; text: its texts joined by one
    space in box order; digits: theirs. columns: struct(col_id, n, numeric_frac, digit_frac, mean_digits) over boxes, by
    column. rows: struct(row_id, confidence), the worst of a row's boxes, 1 at most.
    """
    sizes = _sizes(cx)
    n, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
    cols, rows, _ = _laid(cx, cy, gap_x, gap_y, sizes)
    texts, figures, numeric = text.flatten(), digits.flatten(), _flags(number)

    by_col = np.lexsort([cols, doc])
    first = _firsts(doc[by_col], cols[by_col])
    add = lambda v: np.add.reduceat(v[by_col].astype(np.float64), first) if len(first) else np.zeros(0)
    many, numbers = np.diff(np.append(first, len(doc))), add(numeric)
    lengths = add(np.where(numeric, pc.utf8_length(figures).to_numpy(zero_copy_only=False), 0))
    profile = [cols[by_col][first], many, numbers / many, add(_flags(digit)) / many, np.divide(lengths, numbers, out=np.zeros(len(first)), where=numbers > 0)]
    widths = np.bincount(doc[by_col][first], minlength=n)
    columns = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(profile, [pa.int32(), pa.int64(), *[pa.float64()] * 3], strict=True)], ["col_id", "n", "numeric_frac", "digit_frac", "mean_digits"])

    order = np.lexsort([cols, rows, doc])
    d, r, c = doc[order], rows[order].astype(np.int64), cols[order]
    first = _firsts(d, r, c)
    many, lead = np.diff(np.append(first, len(d))), pa.array(order[first])
    shown, figures_of = pc.utf8_trim(texts.take(lead), characters=" "), figures.take(lead)
    if (shared := many > 1).any():  # cells of several boxes
        said, read = [], []
        idx = box_idx.flatten().to_numpy(zero_copy_only=False)
        for a, m in zip(first[shared].tolist(), many[shared].tolist(), strict=True):
            members = sorted((idx[i], texts[i].as_py(), figures[i].as_py()) for i in order[a : a + m].tolist())
            joined = ""
            for _, t, _ in members:
                joined = f"{joined} {t}".strip(" ")
            said.append(joined)
            read.append("".join(f for _, _, f in members))
        shown, figures_of = (pc.replace_with_mask(v, pa.array(shared), pa.array(w, v.type)) for v, w in ((shown, said), (figures_of, read)))
    cells = np.bincount(d[first], minlength=n)
    at = r[first] * widths[d[first]] + c[first]

    first = _firsts(d, r)
    sure = pc.fill_null(conf.flatten(), np.inf).to_numpy(zero_copy_only=False)
    sure = np.where(np.isnan(sure), np.inf, sure)[order]
    worst = np.minimum(1.0, np.minimum.reduceat(sure, first)) if len(first) else np.zeros(0)
    lines = pa.StructArray.from_arrays([pa.array(r[first], pa.int32()), pa.array(worst, pa.float64())], ["row_id", "confidence"])
    made = [_listed(sizes, cols, pa.int32()), _listed(cells, at, pa.int64()), _listed(cells, shown), _listed(cells, figures_of), _listed(widths, columns), _listed(np.bincount(d[first], minlength=n), lines)]
    return pa.StructArray.from_arrays(made, ["cols", "at", "text", "digits", "columns", "rows"])


LIMIT = 3_000_000_000  # the product of two smaller numbers is a 64-bit one; documents with larger ones are worked out by Python's


def _tried(values: np.ndarray, known: np.ndarray, first: np.ndarray, at: tuple[int | None, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows that add up, rows with all numbers) by document for columns (quantity, price, total); None is a quantity of one."""
    q, h, j = at
    whole = known[:, h] & known[:, j] & (True if q is None else known[:, q])
    right = whole & ((values[:, h] if q is None else values[:, q] * values[:, h]) == values[:, j]).astype(bool)
    return np.add.reduceat(right.astype(np.int64), first), np.add.reduceat(whole.astype(np.int64), first)


def best_columns(values: np.ndarray, known: np.ndarray, first: np.ndarray, mags: np.ndarray) -> list[np.ndarray]:
    """[matched, plausible, score, qty, harga, jumlah] by document, of the columns whose rows add up best.

    values, known: (rows, columns), the rows of documents one after another, a document's from first[i] on; mags: (documents,
    columns). Triples first, pairs with an implied quantity of one where no triple matches a row; matched is 0 where no pair
    does either, qty -1 with an implied quantity. Of equals the first in the order of columns is taken.
    """
    width, best = mags.shape[1], [np.zeros(len(first)), np.zeros(len(first)), np.zeros(len(first)), *np.full((3, len(first)), -1)]

    def try_(at: tuple[int | None, int, int], may: np.ndarray | bool) -> None:
        q, h, j = at
        matched, checked = _tried(values, known, first, at)
        plausible = np.ones(len(first)) if q is None else (mags[:, q] <= mags[:, h]).astype(float)
        score = matched / np.maximum(checked, 1)
        better = (matched > best[0]) | ((matched == best[0]) & ((plausible > best[1]) | ((plausible == best[1]) & (score > best[2]))))
        better &= (matched > 0) & may
        for kept, new in zip(best, (matched, plausible, score, -1 if q is None else q, h, j), strict=True):
            kept[better] = new[better] if isinstance(new, np.ndarray) else new

    for at in itertools.permutations(range(width), 3):
        try_(at, True)
    bare = best[0] == 0
    if bare.any():
        for h, j in itertools.permutations(range(width), 2):
            try_((None, h, j), bare)
    return best


def _search(sizes: np.ndarray, widths: np.ndarray, row: np.ndarray, col: np.ndarray, small: np.ndarray, known: np.ndarray, large: dict[int, int], mags: np.ndarray) -> list[np.ndarray]:
    """`best_columns` of documents of `sizes` rows and `widths` columns. A cell's row (counted over all documents), column
    and number are at one place of row, col and small; large: numbers of at least LIMIT by place. mags: by document and column."""
    row_doc, mag_at = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(widths) - widths
    big = np.zeros(len(sizes), bool)
    big[row_doc[row[list(large)]]] = True
    out = [np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros(len(sizes)), *np.full((3, len(sizes)), -1)]
    for width, whole in sorted(set(zip(widths[sizes > 0].tolist(), big[sizes > 0].tolist(), strict=True))):
        docs = (widths == width) & (big == whole) & (sizes > 0)
        rows = docs[row_doc]
        place = np.cumsum(rows) - 1
        at = np.flatnonzero(rows[row] & known & (col < width))
        v, k = np.zeros((rows.sum(), width), object if whole else np.int64), np.zeros((rows.sum(), width), bool)
        v[place[row[at]], col[at]] = [large.get(i, int(small[i])) for i in at.tolist()] if whole else small[at]
        k[place[row[at]], col[at]] = True
        for kept, new in zip(out, best_columns(v, k, np.cumsum(sizes[docs]) - sizes[docs], mags[mag_at[docs][:, None] + np.arange(width)]), strict=True):
            kept[docs] = new
    return out


BEST = {"matched": pa.int32(), "plausible": pa.float64(), "score": pa.float64(), "qty": pa.int32(), "harga": pa.int32(), "jumlah": pa.int32()}


def _struct(values: list[np.ndarray], kinds: dict[str, pa.DataType], none: np.ndarray | None = None) -> pa.Array:
    """Negative numbers are null, and all where `none` is."""
    missing = np.zeros(len(values[0]), bool) if none is None else none
    return pa.StructArray.from_arrays([pa.array(v.astype(t.to_pandas_dtype()), t, mask=missing | (v < 0)) for v, t in zip(values, kinds.values(), strict=True)], list(kinds))


def searched(g: pa.Array, p: pa.Array) -> pa.Array:
    """struct(matched, plausible, score, qty, harga, jumlah) by document, null where no row adds up.

    g: list of maps from columns to numbers, a row each; p: list of magnitudes by column. No product of numbers that fit 38
    digits equals one of them by overflow: larger ones are compared whole.
    """
    vals = g.flatten()
    offsets = vals.offsets.to_numpy()
    span = slice(offsets[0], offsets[-1]) if len(offsets) else slice(0, 0)
    items = vals.items[span]
    above = pc.fill_null(pc.greater_equal(items, pa.scalar(Decimal(LIMIT), items.type)), False)
    small = pc.fill_null(pc.if_else(above, pa.scalar(None, items.type), items), pa.scalar(Decimal(0), items.type)).cast(pa.int64()).to_numpy(zero_copy_only=False)
    large = {i: int(items[i].as_py()) for i in np.flatnonzero(above.to_numpy(zero_copy_only=False)).tolist()}
    row = np.repeat(np.arange(len(vals)), np.diff(offsets))
    out = _search(_sizes(g), _sizes(p), row, vals.keys[span].to_numpy(zero_copy_only=False), small, items.is_valid().to_numpy(zero_copy_only=False), large, p.flatten().to_numpy(zero_copy_only=False))
    return _struct(out, BEST, out[0] == 0)


def _numbers(digits: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, int]]:
    """(number, whether there is one, as a double, those of at least LIMIT by place) of texts of digits: none in an empty text or beyond
    38 digits."""
    bare = pc.utf8_ltrim(pc.fill_null(digits, ""), characters="0")
    length = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    known = (pc.fill_null(pc.utf8_length(digits), 0).to_numpy(zero_copy_only=False) > 0) & (length <= 38)
    short = pa.array(known & (length > 0) & (length <= 18))
    small = pc.if_else(short, bare, "0").cast(pa.int64()).to_numpy(zero_copy_only=False)
    large = {i: int(bare[i].as_py()) for i in np.flatnonzero(known & ((small >= LIMIT) | (length > 18))).tolist()}
    double = small.astype(np.float64)
    for i, v in large.items():
        double[i] = float(v)
    return small, known, double, large


def _magnitudes(doc: np.ndarray, col: np.ndarray, double: np.ndarray, known: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The upper median of the numbers of each column, infinite without any; documents one after another."""
    at, v = ((np.cumsum(widths) - widths)[doc] + col)[known], double[known]
    v = v[np.lexsort([v, at])]
    many = np.bincount(at, minlength=widths.sum())
    first = np.cumsum(many) - many
    out = np.full(widths.sum(), np.inf)
    out[many > 0] = v[(first + many // 2)[many > 0]]
    return out


def _wordiest(may: np.ndarray, numeric: np.ndarray, n: np.ndarray) -> np.ndarray:
    """By row of the matrices, the column with the most that is no number, then the most boxes, then the first; -1 without any."""
    key = np.where(may, 1 - numeric, -1.0)
    key = np.where(may & (key == key.max(axis=1, keepdims=True)), n, -1)
    return np.where(may.any(axis=1), key.argmax(axis=1), -1)


def _convention(rows: np.ndarray, n: np.ndarray, numeric: np.ndarray, digit: np.ndarray, mean: np.ndarray, mag: np.ndarray) -> list[np.ndarray]:
    """[qty, harga, jumlah], -1 for none, by the layout that the forms share: the largest money is the total, the next with
    three digits the price, the smallest column besides those and the wordiest the quantity."""
    place = np.arange(n.shape[1])
    dense = n >= np.maximum(2.0, rows * 0.25)[:, None]
    money = dense & (digit >= 0.3)
    top = lambda may: np.where(may.any(axis=1), np.where(may, mag, -1.0).argmax(axis=1), -1)
    jumlah = top(money)
    harga = top(money & (place != jumlah[:, None]) & (mean >= 3))
    wordy = _wordiest(dense, numeric, n)
    spare = dense & (place != jumlah[:, None]) & (place != harga[:, None]) & (place != wordy[:, None])
    least = np.where(spare, mag, np.inf).min(axis=1, keepdims=True)
    qty = np.where(spare.any(axis=1), (spare & (mag == least)).argmax(axis=1), -1)
    return [np.where(money.any(axis=1), v, -1) for v in (qty, harga, jumlah)]


def _reading(sizes: np.ndarray, row: np.ndarray, col: np.ndarray, numbers: tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, int]], widths: np.ndarray, profile: list[np.ndarray]) -> list[np.ndarray]:
    """[matched, plausible, score, qty, harga, jumlah, nama] by document: columns whose rows add up best, else those of the
    convention, and the wordiest of the others. profile: n, numeric_frac, digit_frac, mean_digits by document and column."""
    small, known, double, large = numbers
    mags = _magnitudes(np.repeat(np.arange(len(sizes)), sizes)[row], col, double, known, widths)
    out = [*_search(sizes, widths, row, col, small, known, large, mags), np.full(len(sizes), -1)]
    start = np.cumsum(widths) - widths
    for width in sorted(set(widths[widths > 0].tolist())):
        docs = np.flatnonzero(widths == width)
        matrices = [v[start[docs][:, None] + np.arange(width)] for v in (*profile, mags)]
        bare = out[0][docs] == 0
        for kept, new in zip(out[3:6], _convention(sizes[docs], *matrices), strict=True):
            kept[docs] = np.where(bare, new, kept[docs])
        used = np.logical_or.reduce([np.arange(width) == kept[docs][:, None] for kept in out[3:6]])
        out[6][docs] = _wordiest(~used, matrices[1], matrices[0])
    return out


def _cells(at: pa.Array, n: pa.Array) -> tuple[np.ndarray, ...]:
    """(rows by document, row of each cell over all documents, its column, its document, columns by document)."""
    sizes, widths = _sizes(at), _sizes(n)
    doc, at = np.repeat(np.arange(len(sizes)), sizes), at.flatten().to_numpy(zero_copy_only=False)
    first = _firsts(doc, line := at // np.maximum(widths[doc], 1))
    row = np.zeros(len(doc), np.int64)
    row[first[1:]] = 1
    return np.bincount(doc[first], minlength=len(sizes)), np.cumsum(row), at - line * widths[doc], doc, widths


CHOSEN = BEST | {"nama": pa.int32()}


def plain_roles(at: pa.Array, digits: pa.Array, *profile: pa.Array) -> pa.Array:
    """struct(matched, plausible, score, qty, harga, jumlah, nama) by document, from the lists that `gridded` makes: the
    cells as they are. profile: n, numeric_frac, digit_frac, mean_digits by column."""
    rows, row, col, _, widths = _cells(at, profile[0])
    return _struct(_reading(rows, row, col, _numbers(digits.flatten()), widths, [v.flatten().to_numpy(zero_copy_only=False) for v in profile]), CHOSEN)


def split_roles(at: pa.Array, digits: pa.Array, counts: pa.Array, names: pa.Array, *profile: pa.Array) -> pa.Array:
    """`plain_roles` with split_col, null in a document read as it is: the first column at least half of whose cells, two at
    least, are a count welded to a name is read as names, the counts as a new last column, if that matches as many rows.

    counts, names: the count of a welded cell, null in others, and the digits of its name.
    """
    rows, row, col, doc, widths = _cells(at, profile[0])
    profile = [v.flatten().to_numpy(zero_copy_only=False) for v in profile]
    read, figures = _reading(rows, row, col, _numbers(digits.flatten()), widths, profile), digits.flatten()
    split = np.full(len(rows), -1)
    welded = counts.flatten().is_valid().to_numpy(zero_copy_only=False)
    start = np.cumsum(widths) - widths
    many, cut = (np.bincount((start[doc] + col)[w], minlength=widths.sum()) for w in (np.ones(len(col), bool), welded))
    ruled = np.flatnonzero((many >= 2) & (cut >= many * 0.5))
    owner = np.repeat(np.arange(len(rows)), widths)[ruled]
    first = _firsts(owner)
    split[owner[first]] = ruled[first] - start[owner[first]]
    if (docs := split >= 0).any():
        inside = docs[doc]
        parted = inside & welded & (col == split[doc])
        name = pc.if_else(pa.array(parted), names.flatten(), figures).filter(pa.array(inside))
        count = pc.cast(counts.flatten().filter(pa.array(parted)), pa.string())
        number = np.cumsum(docs) - 1
        kept = docs[np.repeat(np.arange(len(rows)), rows)]
        line = np.concatenate([row[inside], row[parted]])
        order = np.argsort(line, kind="stable")
        wide, new = widths[docs] + 1, np.bincount(number[doc[parted]], minlength=docs.sum())
        lengths = np.bincount(number[doc[parted]], pc.utf8_length(count).to_numpy(zero_copy_only=False), docs.sum())
        ends, old = np.cumsum(widths[docs]), np.repeat(docs, widths)
        wider = [np.insert(v[old], ends, x) for v, x in zip(profile, (new, np.ones(len(new)), np.ones(len(new)), lengths / np.maximum(new, 1)), strict=True)]
        numbers = _numbers(pa.concat_arrays([name, count.cast(name.type)]).take(pa.array(order)))
        other = _reading(rows[docs], (np.cumsum(kept) - 1)[line[order]], np.concatenate([col[inside], widths[doc[parted]]])[order], numbers, wide, wider)
        better = other[0] >= read[0][docs]
        for mine, theirs in zip(read, other, strict=True):
            mine[docs] = np.where(better, theirs, mine[docs])
        split[docs] = np.where(better, split[docs], -1)
    return _struct([*read, split], CHOSEN | {"split_col": pa.int32()})


def most_frequent(keys: pa.Array, values: pa.Array, box_idx: pa.Array, counted: pa.Array) -> pa.Array:
    """map(key, value) by document: the most frequent value of each key, among equals the one met first by box_idx; of the places
    where `counted` is not missing. Missing keys count nowhere."""
    sizes, key, value = _sizes(keys), keys.flatten(), values.flatten()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    may = np.flatnonzero(counted.flatten().is_valid().to_numpy(zero_copy_only=False) & key.is_valid().to_numpy(zero_copy_only=False) & value.is_valid().to_numpy(zero_copy_only=False))
    k, v = (pc.fill_null(x.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)[may] for x in (key, value))
    d, idx = doc[may], box_idx.flatten().to_numpy(zero_copy_only=False)[may]
    order = np.lexsort([idx, v, k, d])
    first = _firsts(d[order], k[order], v[order])
    many, at = np.diff(np.append(first, len(order))), order[first]
    rank = np.lexsort([idx[at], -many, k[at], d[at]])
    best = at[rank][_firsts(d[at][rank], k[at][rank])]
    take = pa.array(may[best])
    ends = np.concatenate([[0], np.cumsum(np.bincount(d[best], minlength=len(sizes)))])
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), key.take(take), value.take(take))
