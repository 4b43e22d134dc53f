"""Byte n-grams of documents and the two smoothed models built on them.

A document is its bytes followed by one end symbol, preceded by ``depth``
boundary symbols.  0xFF (never part of UTF-8) serves as end and boundary; a
stray 0xFF in a text is read as 0xFE.  A gram is a symbol with the ``depth``
symbols before it, packed big-endian into 64 bits, the symbol lowest; so a
shorter context is a mask, and sorting by gram also sorts by context.
"""
from __future__ import annotations

import numpy as np

MAX_DOCS = 1 << 16  # of one block: gram (48 bits at most) and document share 64 bits
NO_FF = bytes(range(255)) + b"\xfe"


def mask(n_symbols: int) -> np.uint64:
    return np.uint64((1 << (8 * n_symbols)) - 1)


def doc_grams(texts: list[bytes], depth: int) -> np.ndarray:
    """Sorted (gram << 16 | document) of every symbol of every text."""
    pad = b"\xff" * depth
    tail = b"\xff" + pad
    # 8 spare bytes in front let every gram be read as one big-endian word
    buf = b"\0" * (7 - depth) + pad + b"".join([x for t in texts for x in (t.translate(NO_FF), tail)])
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 1 + depth
    n = int(lens.sum())
    codes = np.ndarray((n,), dtype=">u8", buffer=buf, strides=(1,)).astype(np.uint64)
    codes &= mask(depth + 1)
    codes <<= np.uint64(16)
    codes |= np.repeat(np.arange(len(texts), dtype=np.uint16), lens)
    # the boundary symbols behind each text are no symbols of it: they sort last and are cut off
    ends = np.cumsum(lens)
    for k in range(depth):
        codes[ends - 1 - k] = np.uint64(0xFFFFFFFFFFFFFFFF)
    codes.sort()
    return codes[:n - depth * len(texts)]


def spans(sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct grams, where each one's entries start, document of each entry).  Overwrites its input."""
    docs = sorted_codes.astype(np.uint16)  # the low 16 bits
    grams = sorted_codes
    grams >>= np.uint64(16)
    if not len(grams):
        return grams, np.empty(0, np.int64), docs
    first = np.empty(len(grams), bool)
    first[0] = True
    np.not_equal(grams[1:], grams[:-1], out=first[1:])
    at = np.flatnonzero(first)
    return grams[at], at, docs


def runs(sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct grams, index of the gram of each entry, document of each entry).  Overwrites its input."""
    grams, at, docs = spans(sorted_codes)
    return grams, np.repeat(np.arange(len(grams)), np.diff(np.append(at, len(docs)))), docs


def sums_by_doc(values: np.ndarray, at: np.ndarray, docs: np.ndarray, n_docs: int, piece: int = 1 << 20) -> np.ndarray:
    """Per document the sum of its entries' values, one value a distinct gram; a piece of the entries at a time."""
    out = np.zeros(n_docs)
    for lo in range(0, len(docs), piece):
        hi = min(lo + piece, len(docs))
        a, b = np.searchsorted(at, lo, side="right") - 1, np.searchsorted(at, hi)
        size = np.diff(np.concatenate(([lo], at[a + 1:b], [hi])))
        out += np.bincount(docs[lo:hi], weights=np.repeat(values[a:b], size), minlength=n_docs)
    return out


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of each one's values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[at], np.add.reduceat(values[order], at)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, found) of each key in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


# ---- contexts ---------------------------------------------------------------------------------

def level(keys: np.ndarray, counts: np.ndarray) -> dict:
    """One order of the tree: its (context, symbol) entries, and its contexts with total and fan-out."""
    ctx = keys >> np.uint64(8)
    if len(ctx):
        at = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1])))
        total, fan = np.add.reduceat(counts, at), np.diff(np.append(at, len(ctx)))
    else:
        at, total, fan = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    return {"keys": keys, "counts": counts, "at": at, "ctx": ctx[at] if len(ctx) else ctx, "total": total, "fan": fan}


def levels_from(keys: np.ndarray, counts: np.ndarray, orders: range) -> list[dict]:
    """Orders by summing longer grams; ``keys`` are distinct and counted above zero."""
    return [level(*summed(keys & mask(o + 1), counts)) for o in orders]


# ---- prediction by partial matching ---------------------------------------------------------------

def ppm_tree(levels: list[dict]) -> list[dict]:
    """Add to each context y of order o + 1 what its symbols weigh in its parent
    (order o): after an escape from y they are excluded there."""
    for o in range(1, len(levels)):
        up, here = levels[o - 1], levels[o]
        at, _ = find(up["keys"], here["keys"] & mask(o))
        here["out"] = (np.add.reduceat(up["counts"][at], here["at"]) if len(here["at"]) else np.empty(0))
    return levels


def ppm_log10(levels: list[dict], grams: np.ndarray) -> np.ndarray:
    """log10 P(symbol | context) by the longest seen context, escaping to shorter ones.

    Escape estimate: half a count is taken from every distinct symbol, so
    escaping costs (distinct symbols / 2) / total.  Symbols that a longer
    context has seen are excluded from the shorter ones.  Below order 0 the
    symbols never seen are equally likely.
    """
    out = np.zeros(len(grams))
    open_ = np.arange(len(grams))          # grams whose symbol is not found yet
    less, fewer = np.zeros(len(grams)), np.zeros(len(grams))  # excluded weight and symbols
    for o in range(len(levels) - 1, -1, -1):
        lv = levels[o]
        g = grams[open_]
        at, seen = find(lv["ctx"], (g >> np.uint64(8)) & mask(o))
        if not len(lv["ctx"]):
            continue
        total = lv["total"][at] - less[open_]
        fan = lv["fan"][at] - fewer[open_]
        pos, hit = find(lv["keys"], g & mask(o + 1))
        hit &= seen
        # a context that has seen every symbol needs no escape
        taken = np.where(lv["fan"][at] >= 256, 0.0, 0.5)
        found = open_[hit]
        out[found] += np.log10((lv["counts"][pos[hit]] - taken[hit]) / total[hit])
        esc = seen & ~hit & (fan > 0)
        out[open_[esc]] += np.log10(taken[esc] * fan[esc] / total[esc])
        past = seen & ~hit
        less[open_[past]] = lv["out"][at[past]] if o else 0
        fewer[open_[past]] = lv["fan"][at[past]]
        # a context not seen at all excludes nothing
        less[open_[~seen]] = 0
        fewer[open_[~seen]] = 0
        open_ = open_[~hit]
    if len(open_):
        out[open_] -= np.log10(256 - fewer[open_])
    return out


# ---- interpolated modified Kneser-Ney ---------------------------------------------------------------

def kn_levels(keys: np.ndarray, counts: np.ndarray, depth: int, lowest: int) -> list[dict]:
    """Order ``depth`` with its counts, shorter orders (down to ``lowest``) with
    the number of distinct symbols seen before each gram."""
    tops = level(keys, counts)
    got = [tops]
    for o in range(depth - 1, lowest - 1, -1):
        longer = got[0]["keys"]
        k = longer & mask(o + 1)
        got.insert(0, level(*summed(k, np.ones(len(k)))))
    return got


def kn_discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2 and 3 or more from the numbers of grams counted 1..4 times."""
    n1, n2, n3, n4 = (max(float(x), 0.0) for x in n)
    if n1 == 0 or n2 == 0:
        return np.array([0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5])
    return np.clip(d, [0.05, 0.1, 0.15], [0.95, 1.9, 2.9])


def count_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.array([(counts == j).sum() for j in (1, 2, 3, 4)], float)


def kn_log10(levels: list[dict], discounts: list[np.ndarray], grams: np.ndarray) -> np.ndarray:
    """log10 of the interpolated probability, from the uniform distribution up."""
    p = np.full(len(grams), 1 / 256)
    for o, lv in enumerate(levels):
        if not len(lv["ctx"]):
            continue
        d = np.concatenate(([0.0], discounts[o]))
        kind = np.minimum(lv["counts"], 3).astype(int)
        held = np.add.reduceat(d[kind], lv["at"]) / lv["total"]
        at, seen = find(lv["ctx"], (grams >> np.uint64(8)) & mask(o))
        pos, hit = find(lv["keys"], grams & mask(o + 1))
        own = np.where(hit, lv["counts"][pos] - d[kind[pos]], 0.0) / lv["total"][at]
        p = np.where(seen, own + held[at] * p, p)
    return np.log10(p)
