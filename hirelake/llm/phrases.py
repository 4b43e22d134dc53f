"""Operator 11, phrase collocation mining with Rabin-Karp fingerprints.

Texts lie in compressed blocks of a few megabytes.  Within a block, prefix
polynomials over bytes give every word a hash, and prefix polynomials over word
hashes give every n-gram a fingerprint in one step.  A block sends each distinct
fingerprint once, with its count and a pointer to an occurrence; ranges of
fingerprints add up the counts and send the pointers of frequent ones back.
Only there is text read again: the blocks write out the phrases under these
pointers, and the ranges add up counts by text, so two phrases with one
fingerprint never count as one.

Words and pairs are counted first.  A longer phrase cannot be more frequent than
a pair inside it, so three to five words are fingerprinted where all their pairs
are frequent: nothing that can reach the minimum count is left out.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from hirelake.llm.blocks import arrow_of, batch_of, emitted, rows_of, spread, squeeze
from hirelake.llm.common import keyed_stream, read, text_bytes, written

SEPARATORS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST = 5
BLOCK_BYTES = 4 << 20
RANGE_WORDS = 1 << 21
STRETCH = 1 << 18
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
KIND = np.zeros(256, np.uint8)
KIND[list(SEPARATORS)], KIND[list(BLANKS)] = 2, 1
BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r \t]")
TAIL = re.compile(rb"[ \t]*(?:[^.,;:!?\n\x0b\x0c\r \t]+[ \t]+){0,%d}[^.,;:!?\n\x0b\x0c\r \t]*" % (LONGEST - 2))


def segments(text: bytes, most: int):
    """(segment, own): a text in parts of about ``most`` bytes, cut at separators.

    A piece that is longer is cut between two words; the next words follow the
    cut as a tail, in which n-grams end but none starts (it begins at ``own``).
    """
    at = 0
    while len(text) - at > most:
        window = text[at:at + most]
        cut = max(window.rfind(bytes([c])) for c in SEPARATORS) + 1
        tail = cut
        if not cut:
            cut = max(window.rfind(bytes([c])) for c in BLANKS) + 1
            if not cut:
                found = BREAK.search(text, at + most)
                cut = (found.end() if found else len(text)) - at
            tail = TAIL.match(text, at + cut).end() - at if KIND[text[at + cut - 1]] != 2 else cut
        yield text[at:at + tail], cut
        at += cut
    if at < len(text) or not text:
        yield text[at:], len(text) - at


def packed(docs: DataFrame, text_col: str, lang_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Whole texts, A-Z lower-cased, as blocks of segments with their languages (null: ``und``)."""
    ddl = "block bigint, langs array<string>, lens binary, own binary, payload binary, words bigint"
    out = arrow_of(ddl)

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        z = zstandard.ZstdCompressor(level=3)
        base, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block():
            return batch_of(out, [(base + k, [h[0] for h in held], np.array([len(h[1]) for h in held], np.int64).tobytes(),
                                   np.array([h[2] for h in held], np.int64).tobytes(), z.compress(b"\n".join(h[1] for h in held)),
                                   sum(len(h[1].split()) for h in held))])

        for lang, text in rows_of(batches):
            for part, own in segments(text.lower(), block_bytes):
                if held and size + len(part) > block_bytes:
                    yield block()
                    held, size, k = [], 0, k + 1
                held.append((lang, part, own))
                size += len(part) + 1
        if held:
            yield block()

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    src = docs.select(lang.alias("lang"), text_bytes(F.col(f"`{text_col}`")).alias("text"))
    return written(src.mapInArrow(run, ddl), "phrase_blocks")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            one = np.ones(1, np.uint64)
            self.up = np.concatenate((one, np.cumprod(np.full(n, self.base), dtype=np.uint64)))
            self.down = np.concatenate((one, np.cumprod(np.full(n, self.inverse), dtype=np.uint64)))
        return self.up, self.down


def prefix_sums(symbols: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(len(symbols))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * up[:len(symbols)], dtype=np.uint64)))


class Block:
    """The words of a block and the fingerprints of its n-grams.

    ``bits`` shortens hashes; results do not depend on it.
    """

    byte_powers, word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)

    def __init__(self, langs: list[str], lens: bytes, own: bytes, payload: bytes, bits: int = 64):
        import zstandard
        from zlib import crc32

        self.langs, self.cut = langs, np.uint64(64 - bits)
        self.text = zstandard.ZstdDecompressor().decompress(payload) + b" "
        self.raw = raw = np.frombuffer(self.text, np.uint8)
        kind = KIND[raw]
        edges = np.diff((kind == 0).astype(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        begin = np.cumsum(np.frombuffer(lens, np.int64) + 1) - np.frombuffer(lens, np.int64) - 1
        self.segment = np.searchsorted(begin, self.starts, "right") - 1
        self.owned = self.starts < (begin + np.frombuffer(own, np.int64))[self.segment]
        words = self._word_hashes(raw) >> self.cut
        self.ids = self._word_ids(raw, words)
        self.names = list(dict.fromkeys(langs))
        self.lang = np.array([self.names.index(x) for x in langs], np.int64)[self.segment]
        self.seed = mixed(np.array([crc32(x.encode()) + (len(x) << 32) for x in self.names], np.uint64) + np.uint64(1))[self.lang]
        self.sums = prefix_sums(words, self.word_powers)

    def _word_hashes(self, raw: np.ndarray) -> np.ndarray:
        """Hashes of all words, by prefix polynomials over stretches of about ``STRETCH`` bytes."""
        out = np.empty(len(self.starts), np.uint64)
        cuts = np.unique(np.append(np.searchsorted(self.starts, np.arange(0, len(raw), STRETCH)), len(self.starts)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi = self.starts[a], self.ends[b - 1]
            sums = prefix_sums(raw[lo:hi].astype(np.uint64) + np.uint64(1), self.byte_powers)
            down = self.byte_powers.upto(hi - lo)[1]
            out[a:b] = (sums[self.ends[a:b] - lo] - sums[self.starts[a:b] - lo]) * down[self.starts[a:b] - lo]
        return mixed(out)

    def _word_ids(self, raw: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Equal for equal words only: each word is compared with the first one of its hash."""
        _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
        size, model = self.ends - self.starts, self.starts[first][ids]
        same = size == size[first][ids]
        for k in np.flatnonzero(same & (size > 64)).tolist():
            same[k] = self.text[self.starts[k]:self.ends[k]] == self.text[model[k]:model[k] + size[k]]
        left = np.flatnonzero(same & (size <= 64))
        step = 0
        while len(left):
            left = left[size[left] > step]
            differ = raw[self.starts[left] + step] != raw[model[left] + step]
            same[left[differ]] = False
            left, step = left[~differ], step + 1
        if same.all():
            return ids
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(self.text[a:b], len(seen)) for a, b in zip(self.starts.tolist(), self.ends.tolist())], np.int64)

    def whole(self, n: int) -> np.ndarray:
        """Whether ``n`` words from each word on lie in one piece."""
        last = max(0, len(self.starts) - n + 1)
        return self.piece[:last] == self.piece[n - 1:]

    def prints(self, n: int, at: np.ndarray) -> np.ndarray:
        down = self.word_powers.upto(len(self.starts))[1]
        return mixed((self.sums[at + n] - self.sums[at]) * down[at] + self.seed[at]) >> self.cut

    def entries(self, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, count, position of an occurrence) of the distinct phrases that start ``at``, by fingerprint.
        Only owned occurrences count."""
        prints = self.prints(n, at)
        order = np.argsort(prints, kind="stable")
        p, at = prints[order], at[order]
        if not len(p):
            return p, order, at
        new = np.concatenate(([True], p[1:] != p[:-1]))
        lead = at[new][np.cumsum(new) - 1]
        columns = [self.ids[at + k] for k in range(n)] + [self.lang[at]]
        if any((c != m).any() for c, m in zip(columns, [self.ids[lead + k] for k in range(n)] + [self.lang[lead]])):
            order = np.lexsort((at, *columns, p))
            p, at, columns = p[order], at[order], [c[order] for c in columns]
            new = np.concatenate(([True], (p[1:] != p[:-1]) | np.any([c[1:] != c[:-1] for c in columns], axis=0)))
        first = np.flatnonzero(new)
        return p[first], np.add.reduceat(self.owned[at], first, dtype=np.int64), at[first]

    def phrases(self, n: int, at: np.ndarray) -> bytes:
        """The phrases of ``n`` words that start at the given words: words joined by spaces, a line break after each phrase."""
        words = (at[:, None] + np.arange(n)).ravel()
        size = self.ends[words] - self.starts[words] + 1
        stop = np.cumsum(size)
        out = self.raw[np.arange(stop[-1]) + np.repeat(self.starts[words] - (stop - size), size)]
        out[stop - 1] = 0x20
        out[stop[n - 1::n] - 1] = 0x0A
        return out.tobytes()


def _rows(block: int, n: int, entries, ranges: int, bits: int):
    """Entries of a block, one row for each range of fingerprints."""
    prints, counts, at = entries
    ends = np.searchsorted(prints, np.array([(k << bits) // ranges for k in range(1, ranges)] or [], np.uint64)).tolist()
    for k, (a, b) in enumerate(zip([0, *ends], [*ends, len(prints)])):
        if a < b:
            yield k, n, block, squeeze(np.diff(prints[a:b], prepend=np.uint64(0))), squeeze(counts[a:b]), squeeze(at[a:b].astype(np.uint32))


ENTRY = "part int, n int, block bigint, prints binary, counts binary, at binary"
REPLY = "block bigint, part int, n int, prints binary, counts binary, at binary"
TEXTS = "lang string, part int, n int, texts binary, counts binary"
FOUND = "lang string, n int, phrase binary, f bigint"


def frequent(entries: DataFrame, least: int) -> DataFrame:
    """The blocks' entries whose fingerprints are counted ``least`` times over all blocks."""
    out = arrow_of(REPLY)

    def replies(key, held):
        blocks = np.array([h[0] for h in held], np.int64)
        sizes = [len(h[1]) for h in held]
        prints, counts, at = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        source = np.repeat(np.arange(len(held)), sizes)
        _, number = np.unique(prints, return_inverse=True)
        total = np.zeros(number.max() + 1, np.int64)
        np.add.at(total, number, counts)
        keep = np.flatnonzero(total[number] >= least)
        ends = np.searchsorted(source[keep], np.arange(1, len(held) + 1)).tolist()
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            if a < b:
                x = keep[a:b]
                yield int(blocks[k]), *key, squeeze(np.diff(prints[x], prepend=np.uint64(0))), squeeze(counts[x]), squeeze(at[x])

    def merged(rows):
        key, held = None, []
        for part, n, block, prints, counts, at in rows:
            if (part, n) != key:
                if held:
                    yield from replies(key, held)
                key, held = (part, n), []
            held.append((block, np.cumsum(spread(prints, np.uint64), dtype=np.uint64), spread(counts, np.int64), spread(at, np.uint32)))
        if held:
            yield from replies(key, held)

    return keyed_stream(entries, ["part", "n"], [], lambda it: emitted(merged(rows_of(it)), out), REPLY)


def _with_replies(blocks: DataFrame, replies: DataFrame, fn, ddl: str) -> DataFrame:
    """``fn(block number, Block arguments, {n: replies})`` for every block."""
    blank = lambda t: F.lit(None).cast(t)
    asked = replies.select("block", F.lit(0).alias("role"), "part", "n", "prints", "counts", "at", blank("array<string>").alias("langs"))
    whole = blocks.select("block", F.lit(1).alias("role"), F.lit(0).alias("part"), F.lit(0).alias("n"), F.col("lens").alias("prints"), F.col("own").alias("counts"),
                          F.col("payload").alias("at"), "langs")
    out = arrow_of(ddl)

    def run(rows):
        here, got = None, {}
        for block, role, part, n, a, b, c, langs in rows:
            if block != here:
                here, got = block, {}
            if role == 0:
                got.setdefault(n, []).append((part, a, b, c))
            else:
                yield from fn(block, (langs, a, b, c), got)

    return keyed_stream(asked.unionByName(whole), ["block"], ["role"], lambda it: emitted(run(rows_of(it)), out), ddl)


def _texts(block: Block, n: int, replies):
    """The phrases under the pointers of a block's frequent entries with their counts, a row for each range and language."""
    for part, _, counts, at in replies:
        counts, at = spread(counts, np.int64), spread(at, np.uint32).astype(np.int64)
        lang = block.lang[at]
        for k in np.unique(lang[counts > 0]).tolist():
            mine = (lang == k) & (counts > 0)
            yield block.names[k], part, n, squeeze(np.frombuffer(block.phrases(n, at[mine]), np.uint8)), squeeze(counts[mine])


def _by_text(texts: DataFrame, least: int) -> DataFrame:
    """(lang, n, phrase, f) of the phrases that the blocks' rows count ``least`` times; memory holds the phrases of one range."""
    out = arrow_of(FOUND)

    def merged(rows):
        key, held = None, {}
        for lang, part, n, blob, counts in rows:
            if (lang, part, n) != key:
                yield from ((key[0], key[2], p, f) for p, f in held.items() if f >= least)
                key, held = (lang, part, n), {}
            for p, c in zip(spread(blob, np.uint8).tobytes().split(b"\n"), spread(counts, np.int64).tolist()):
                held[p] = held.get(p, 0) + c
        yield from ((key[0], key[2], p, f) for p, f in held.items() if f >= least)

    return keyed_stream(texts, ["lang", "part", "n"], [], lambda it: emitted(merged(rows_of(it)), out), FOUND)


def phrase_counts(docs: DataFrame, least: int = 100, text_col: str = "text", lang_col: str = "lang", bits: int = 64,
                  block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f): the exact counts of every phrase of one to five words that occurs at least ``least``
    times in its language; and (lang, total): the number of word occurrences."""
    blocks = packed(docs, text_col, lang_col, block_bytes)
    words = blocks.agg(F.sum("words")).first()[0] or 0
    ranges = max(1, -(-words // RANGE_WORDS))

    entry_out = arrow_of(ENTRY)

    def pairs(batches):
        def rows():
            for number, *args in rows_of(batches):
                block = Block(*args, bits)
                for n in (1, 2):
                    yield from _rows(number, n, block.entries(n, np.flatnonzero(block.whole(n))), ranges, bits)
        return emitted(rows(), entry_out)

    first = frequent(blocks.select("block", "langs", "lens", "own", "payload").mapInArrow(pairs, ENTRY), least)

    def longer(number, args, got):
        block = Block(*args, bits)
        size = np.bincount(block.lang[block.owned], minlength=len(block.names))
        for lang, k in zip(block.names, size.tolist()):
            yield lang, None, 0, None, None, k, None, None, None
        for n in (1, 2):
            for row in _texts(block, n, got.get(n, [])):
                yield *row, None, None, None, None
        known = [np.cumsum(spread(p, np.uint64), dtype=np.uint64) for _, p, _, _ in got.get(2, [])]
        if not known:
            return
        at = np.flatnonzero(block.whole(2))
        common = np.zeros(len(block.starts), bool)
        common[at] = np.isin(block.prints(2, at), np.concatenate(known))
        for n in range(3, LONGEST + 1):
            fits = block.whole(n)
            fits &= block.owned[:len(fits)]
            for k in range(n - 1):
                fits &= common[k:k + len(fits)]
            for part, _, _, p, c, w in _rows(number, n, block.entries(n, np.flatnonzero(fits)), ranges, bits):
                yield None, part, n, None, c, None, number, p, w

    second = written(_with_replies(blocks, first, longer, TEXTS + ", words bigint, block bigint, prints binary, at binary"), "phrases_short")
    entries = second.where("block is not null").select("part", "n", "block", "prints", "counts", "at")

    def last(number, args, got):
        if got:
            block = Block(*args, bits)
            for n, replies in got.items():
                yield from _texts(block, n, replies)

    third = _with_replies(blocks, frequent(entries, least), last, TEXTS)
    short = second.where("block is null")
    found = _by_text(short.where("n > 0").select(*third.columns).unionByName(third), least)
    totals = short.where("n = 0").groupBy("lang").agg(F.sum("words").alias("total"))
    return written(found.withColumn("phrase", F.col("phrase").cast("string")), "phrases"), totals


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, inside_percent: int = 100, text_col: str = "text",
                 lang_col: str = "lang", **more) -> DataFrame:
    """The best phrases of two to five words of every language: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null language is ``und``; repeated rows count each
    time; phrases with equal score and count are ranked by their bytes; other
    columns are ignored; an empty table gives no rows.  A phrase is dropped when
    one that holds it has ``inside_percent`` of its count.  (Counts fall with
    length, so it is enough to look at phrases that are longer by one word.)
    """
    found, totals = phrase_counts(docs, least, text_col, lang_col, **more)
    words = F.split("phrase", " ", -1)
    part = lambda a, b: F.array_join(F.slice(words, a, b), " ")
    held = (found.where("n > 2").select("lang", "f", F.explode(F.array(part(F.lit(1), F.col("n") - 1), part(F.lit(2), F.col("n") - 1))).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    cand = found.where("n > 1").join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("f")))
    cuts = (cand.select("lang", "phrase", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("rest")))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"({wide('a')} * 1000 * {wide('total')}) div ({wide('l')} * {wide('r')})")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn("score", score)
              .groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").alias("score")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT g.lang, g.phrase, g.f, g.k, c.cut, string_split(g.phrase, ' ') AS w
  FROM grams g, (SELECT unnest(range(1, 5)) AS cut) c WHERE c.cut < g.k),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, l.f AS l, r.f AS r, t.n,
    ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
cand AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM grams s JOIN grams g
    ON s.lang = g.lang AND g.k > s.k AND s.k > 1 AND 100 * g.f >= 100 * s.f AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')),
kept AS (SELECT * FROM cand ANTI JOIN inside USING (lang, phrase)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked WHERE rank <= 2000
"""
