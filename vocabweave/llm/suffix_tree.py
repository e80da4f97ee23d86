"""Language model scores by a probabilistic suffix tree over words.

Symbols are lower-cased words and one end per text. The states are contexts of one or two words
that the training texts hold at least twice and that a divergence test keeps: the log-likelihood
that the context's own next-symbol distribution gains over its parent's, each occurrence judged
without itself, must reach ``GAIN``. A state's distribution is smoothed with its parent's, as
often as it has different next symbols (Witten-Bell); the root is the smoothed word frequency.
A symbol is scored by the longest state that its text so far ends in.

1. Words are counted over all training texts, which gives the root, and the hot words: those that
   fill more than a part's fair share.
2. Blocks of texts deal their different words by hash and their word pairs by the next word, with
   counts. A part thus knows each pair's count and the exact root probability of its next word;
   it sends both to the part of the first word, which tests that context. Pairs that end in a hot
   word are dealt by hash of both words; pairs that begin with one stay in their slice, and only a
   sum per slice and context meets (first of next symbols, then of what they gain).
3. Counts and tested contexts go back to the block, which scores what ends in a context of one word.
4. Places after a pair that occurs again deal (pair, next word, probability so far) by pair; that
   part counts, tests and scores them, and returns a sum per text. After a hot pair, a block sends
   each different next word once, dealt by hash of all three, and sums are taken as in 2.

Each block sends a word or pair once, so a word that fills a third of all texts costs a row per
block, and no context has to fit a task. The gathered counts grow with the training texts. Words are told apart by 64-bit hashes cut to 40 bits and
their part, contexts of two words within a part by 32 bits and what follows them by 24 (64 bits and a whole name after hot pairs).

Null and empty texts are one end. Rows that are repeated count and are scored as often as they
are there; other columns of the table are ignored. Without training texts the root knows no word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabweave.llm.blocks import LOWER, SPACED, Hashes, mix, owners, text_blocks, words
from vocabweave.llm.bpe import joined, pack, parted, unpack
from vocabweave.session import cut_lineage, shared_folder

GAIN = 3.0
BLOCK_BYTES = 6 << 20
PART_KEYS = 1_500_000
SHARES = 1000

_LOW = np.uint64((1 << 40) - 1)
_END = np.uint64(0xE7037ED1A0B428DB)
PACKED = "part int, block string, kind string, payload binary"
_PACKED = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("payload", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, _PACKED.types, strict=True)], schema=_PACKED)


def _symbols(data: np.ndarray, offsets: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of a block's symbols, an end behind each text's words, and where each text begins."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, SPACED)
    hashes = np.insert(Hashes(data).of(starts, ends), bounds[1:], _END)
    part = (hashes >> np.uint64(40)) % np.uint64(parts)
    return ((part << np.uint64(40)) | (hashes & _LOW)).astype(np.int64), bounds + np.arange(len(bounds))


def _low(names: np.ndarray, size: int = 5) -> np.ndarray:
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).ravel()


def _named(low: bytes, part: int, size: int = 5) -> np.ndarray:
    out = np.zeros((len(low) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(low, np.uint8).reshape(-1, size)
    return out.view("<i8").ravel() | (part << 40)


def _counter(parts: int):
    """Per block and part: the different training words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                names, counts = np.unique(_symbols(data, offsets, parts)[0], return_counts=True)
                cuts = np.searchsorted(names, np.arange(parts + 1) << 40)
                rows = [(p, "", "words", joined(_low(names[a:b]).tobytes(), pack(counts[a:b]))) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                yield from _table(rows).to_batches()

    return run


def _totals(shares: int):
    """Tokens, different words and the most common ones of a part."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        own = [parted(p) for p in table.column("payload").to_pylist()]
        names, inverse = np.unique(np.concatenate([_named(low, part) for low, _ in own]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([unpack(n) for _, n in own])).astype(np.int64)
        common = np.flatnonzero(counts * shares > counts.sum())
        return pa.table({"word": pa.array([None, *names[common].tolist()], pa.int64()), "n": pa.array([int(counts.sum()), *counts[common].tolist()], pa.int64()), "kinds": pa.array([len(names), *[0] * len(common)], pa.int64())})

    return run


def _pairs(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per place its pair (-1: none), and of each different pair the two words."""
    kinds = int(codes.max(initial=0)) + 1
    first = np.zeros(len(codes), bool)
    first[bounds[:-1]] = True
    places = np.flatnonzero(~first)
    keys, inverse = np.unique(codes[places - 1] * kinds + codes[places], return_inverse=True)
    pair = np.full(len(codes), -1, np.int64)
    pair[places] = inverse
    return pair, keys // kinds, keys % kinds, places


def _place(names: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where ``names`` stand in the sorted ``known``; -1: not there."""
    at = np.minimum(np.searchsorted(known, names), max(len(known) - 1, 0))
    return np.where(known[at] == names, at, -1) if len(known) else np.full(len(names), -1, np.int64)


def _led(names: np.ndarray, context: np.ndarray, following: np.ndarray, hot: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in the order they are sent, where each part's begin, and the number of each pair's hot next word or -1."""
    ends = _place(names, hot)[following]
    spread = mix(mix(names[context].astype(np.uint64)) + names[following].astype(np.uint64))
    to = np.where(ends >= 0, (spread >> np.uint64(33)).astype(np.int64) % parts, names[following] >> 40)
    order = np.lexsort((context, following, to))
    return order, np.searchsorted(to[order], np.arange(parts + 1)), ends


def _dealt(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and 32-bit name of contexts."""
    spread = mix(names.astype(np.uint64))
    return (spread >> np.uint64(33)).astype(np.int64) % parts, spread.astype(np.uint32)


def _next(names: np.ndarray) -> np.ndarray:
    return mix(names.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)).astype(np.uint32)


def _splitter(parts: int, hot: np.ndarray):
    """Rows of a block: its texts as word numbers, and its words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for i, j, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                yield from emit(batch.slice(i, j - i), *_symbols(data, offsets, parts), number).to_batches()
                number += 1

    def emit(batch, symbols, bounds, number) -> pa.Table:
        taught = batch.column("taught").to_numpy(zero_copy_only=False).astype(bool)
        doc_ids = batch.column("doc_id")
        names, codes, times = np.unique(symbols, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        names, codes = names[order], rank[codes]
        weight = taught[owners(bounds)].astype(np.float64)
        counts = np.bincount(codes, weight, len(names)).astype(np.int64)

        payload = joined(
            pack(taught), pack(np.diff(bounds)), pack(codes), doc_ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes()
        )
        digest = xxhash.xxh3_64_intdigest(payload)
        # equal blocks of a task differ by their number
        block = f"{TaskContext.get().partitionId()}-{number}-{digest:x}"
        rows = [(digest % parts, block, "texts", payload)]
        by_part = np.argsort(names >> 40, kind="stable")
        cuts = np.searchsorted(names[by_part] >> 40, np.arange(parts + 1))
        within = np.empty(len(names), np.int64)
        within[by_part] = np.arange(len(names)) - cuts[names[by_part] >> 40]

        pair, context, following, places = _pairs(codes, bounds)
        seen = np.bincount(pair[places], weight[places], len(context)).astype(np.int64)
        order, pair_cuts, ends = _led(names, context, following, hot, parts)
        # what a pair ends in: the number of a word of the same row, or of a hot word
        head = np.where(ends >= 0, 2 * ends + 1, 2 * within[following])
        for p in np.flatnonzero(np.diff(cuts) + np.diff(pair_cuts)).tolist():
            own, pairs = by_part[cuts[p] : cuts[p + 1]], order[pair_cuts[p] : pair_cuts[p + 1]]
            heads = np.flatnonzero(np.diff(following[pairs], prepend=-1))
            first = names[context[pairs]]
            rows.append((p, block, "words", joined(
                pack(np.diff(own, prepend=0)), _low(names[own]).tobytes(), pack(counts[own]),
                pack(head[pairs[heads]]), pack(np.diff(np.append(heads, len(pairs)))), _low(first).tobytes(), pack(first >> 40), pack(seen[pairs]),
            )))
        return _table(rows)

    return run


def _without(seen: np.ndarray, total: np.ndarray, kinds: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """What each next symbol of a context adds to the log-likelihood, each occurrence judged without itself."""
    chance = (np.maximum(seen - 1, 0) + kinds * parent) / np.maximum(total - 1 + kinds, 1e-9)
    return np.where(seen > 0, seen * np.log(np.maximum(chance, 1e-300) / parent), 0)


def _tested(context: np.ndarray, seen: np.ndarray, parent: np.ndarray, gain: float) -> tuple[np.ndarray, np.ndarray]:
    """For each context (numbers 0 ..) of (context, next symbol) rows with counts: total, and different next symbols or 0 if it is no state."""
    total = np.bincount(context, seen)
    kinds = np.bincount(context, seen > 0)
    won = np.bincount(context, _without(seen, total[context], kinds[context], parent))
    return total, np.where((won >= gain) & (total >= 2), kinds, 0).astype(np.int64)


def _slice(payloads: list[bytes]) -> tuple[np.ndarray, ...]:
    """Hot contexts of a slice (names), and per different (context, next symbol): number of the context, count, parent's probability; and the row of each that was sent."""
    own = [parted(p) for p in payloads]
    name, following = (np.concatenate([np.frombuffer(x[i], "<i8") for x in own]) for i in range(2))
    contexts, number = np.unique(name, return_inverse=True)
    nexts, after = np.unique(following, return_inverse=True)
    _, first, row = np.unique(number * len(nexts) + after, return_index=True, return_inverse=True)
    seen = np.bincount(row, np.concatenate([unpack(x[2]) for x in own]))
    return contexts, number[first], seen, np.concatenate([np.frombuffer(x[3]) for x in own])[first], row


def _slice_sums(known: dict[int, tuple[int, int]] | None):
    """Per hot context of a slice: count and different next symbols or, once the sums of those are ``known``, what it gains."""

    def run(table: pa.Table) -> pa.Table:
        contexts, number, seen, parent, _ = _slice(table.column("payload").to_pylist())
        total, kinds = np.bincount(number, seen), np.bincount(number, seen > 0)
        won = np.zeros(len(contexts))
        if known is not None:
            n, t = np.array([known[c] for c in contexts.tolist()], float).T
            won = np.bincount(number, _without(seen, n[number], t[number], parent))
        return pa.table({"name": pa.array(contexts), "n": pa.array(total.astype(np.int64)), "kinds": pa.array(kinds.astype(np.int64)), "won": pa.array(won)})

    return run


def _hot_states(slices: DataFrame, gain: float) -> dict[int, tuple[int, int]]:
    """Total and different next symbols, or 0 if it is no state, of the hot contexts of all slices; these are at most one per share."""

    def summed(known):
        sums = slices.groupBy("part").applyInArrow(_slice_sums(known), "name bigint, n bigint, kinds bigint, won double")
        return sums.groupBy("name").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds"), F.sum("won").alias("won")).collect()

    known = {r.name: (r.n, r.kinds) for r in summed(None)}
    won = {r.name: r.won for r in summed(known)} if known else {}
    return {name: (n, kinds if won[name] >= gain and n >= 2 else 0) for name, (n, kinds) in known.items()}


def _part_counter(hot: np.ndarray, hot_counts: np.ndarray, normal: float, limit: float):
    """Counts the words and pairs of a part over all blocks; sends the different pairs to their contexts."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
        out = [r for r in rows if r[2] == "texts"]
        asked = [(r, parted(r[3])) for r in rows if r[2] == "words"]
        if asked:
            words_, inverse = np.unique(np.concatenate([_named(x[1], part) for _, x in asked]), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([unpack(x[2]) for _, x in asked]), len(words_)).astype(np.int64)
            following, at = [], 0
            for r, x in asked:
                n = len(x[1]) // 5
                out.append((*r[:2], "words", joined(x[0], x[1], pack(total[inverse[at : at + n]]))))
                head = unpack(x[3]).astype(np.int64)
                number = len(words_) + (head >> 1)
                plain = head & 1 == 0
                number[plain] = inverse[at + (head[plain] >> 1)]
                following.append(np.repeat(number, unpack(x[4])))
                at += n
            sizes = [len(f) for f in following]
            following = np.concatenate(following)
            contexts, number = np.unique(np.concatenate([_named(x[5], 0) | (unpack(x[6]).astype(np.int64) << 40) for _, x in asked]), return_inverse=True)
            keys, row = np.unique(following * max(len(contexts), 1) + number, return_inverse=True)
            seen = np.bincount(row, np.concatenate([unpack(x[7]) for _, x in asked]), len(keys)).astype(np.int64)
            at = 0
            for (r, _), n in zip(asked, sizes, strict=True):
                out.append((*r[:2], "pairs", pack(seen[row[at : at + n]])))
                at += n
            taught = np.flatnonzero(seen)
            following, number, seen = keys[taught] // max(len(contexts), 1), keys[taught] % max(len(contexts), 1), seen[taught]
            context, times = contexts[number], np.concatenate([total, hot_counts])[following]
            is_hot = (_place(contexts, hot) >= 0)[number]
            if is_hot.any():
                out.append((part, "", "hot", joined(
                    context[is_hot].astype("<i8").tobytes(), np.concatenate([words_, hot])[following[is_hot]].astype("<i8").tobytes(), pack(seen[is_hot]), ((times[is_hot] + 0.5) / normal).tobytes(),
                )))
                if (seen > limit).any():
                    out.append((part, "", "hot pairs", b""))
            others = np.flatnonzero(~is_hot)  # by context, as ``keys`` are by next word
            others = others[np.argsort(context[others], kind="stable")]
            to = context[others] >> 40
            for p in np.unique(to).tolist():
                own = others[np.searchsorted(to, p) : np.searchsorted(to, p, "right")]
                out.append((p, "", "tests", joined(_low(context[own]).tobytes(), pack(seen[own]), pack(times[own]))))
        return _table(out)

    return run


def _tester(states: dict[int, tuple[int, int]], normal: float, gain: float):
    """Tests the contexts of a part and adds them to the answers on words."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
        tests = [parted(r[3]) for r in rows if r[2] == "tests"]
        context = np.concatenate([np.zeros(0, np.int64), *(_named(x[0], part) for x in tests)])
        seen, times = (np.concatenate([np.zeros(0, np.int64), *(unpack(x[i]).astype(np.int64) for x in tests)]) for i in (1, 2))
        names, number = np.unique(context, return_inverse=True)
        _, kinds = _tested(number, seen, (times + 0.5) / normal, gain)
        hot = np.array(sorted(states), np.int64)
        names, kinds = np.concatenate([names, hot]), np.concatenate([kinds, np.array([states[h][1] for h in hot.tolist()], np.int64)])
        order = np.argsort(names)
        names, kinds = names[order], np.append(kinds[order], 0)
        out = []
        for r in rows:
            if r[2] == "words":
                steps, low, total = parted(r[3])
                out.append((*r[:3], joined(steps, low, total, pack(kinds[_place(_named(low, part), names)]))))
        return _table(out)

    return run


def _scorer(parts: int, hot: np.ndarray, normal: float, limit: float):
    """Scores a block by contexts of one word; places after a pair that occurs again go on."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
        texts = [r for r in rows if r[2] == "texts"]
        if len(texts) != 1:
            raise ValueError("the rows of the texts changed between two runs of a task")
        taught, sizes, codes, valid, ids = parted(texts[0][3])
        taught, sizes, codes = unpack(taught).astype(bool), unpack(sizes).astype(np.int64), unpack(codes).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        names, counts, kinds = (np.zeros(int(codes.max(initial=-1)) + 1, np.int64) for _ in range(3))
        for part, _, kind, payload in rows:
            if kind == "words":
                steps, low, total, states = parted(payload)
                at = np.cumsum(unpack(steps).astype(np.int32), dtype=np.int64)
                names[at], counts[at], kinds[at] = _named(low, part), unpack(total), unpack(states)
        pair, context, following, places = _pairs(codes, bounds)
        order, cuts, _ = _led(names, context, following, hot, parts)
        seen = np.zeros(len(context), np.int64)
        for part, _, kind, payload in rows:
            if kind == "pairs":
                seen[order[cuts[part] : cuts[part + 1]]] = unpack(payload)

        chance = (counts + 0.5) / normal
        here = chance[codes]
        p = places[kinds[codes[places - 1]] > 0]
        t = kinds[codes[p - 1]]
        here[p] = (seen[pair[p]] + t * here[p]) / (counts[codes[p - 1]] + t)

        owner = owners(bounds)
        # places whose two words before are a pair that occurs again
        before = np.full(len(codes), -1, np.int64)
        before[1:] = np.where(owner[1:] == owner[:-1], pair[:-1], -1)
        longer = np.flatnonzero(before >= 0)
        longer = longer[seen[before[longer]] >= 2]
        rest = np.ones(len(codes), bool)
        rest[longer] = False
        score = np.bincount(owner[rest], np.log10(here[rest]), len(sizes))
        known = np.bincount(owner, counts[codes] > 0, len(sizes)).astype(np.int64)
        base = np.bincount(owner, np.log10(chance[codes]), len(sizes))

        after_hot = seen[before[longer]] > limit
        hot_places, longer = longer[after_hot], longer[~after_hot]
        keys, first, number = np.unique(before[hot_places] * max(len(names), 1) + codes[hot_places], return_index=True, return_inverse=True)
        at = hot_places[first]
        name = mix(mix(names[codes[at - 2]].astype(np.uint64)) + names[codes[at - 1]].astype(np.uint64))
        to = (mix(name + names[codes[at]].astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % parts
        times = np.bincount(number, taught[owner[hot_places]], len(keys)).astype(np.int64)
        payload = joined(sizes.tobytes(), known.tobytes(), base.tobytes(), score.tobytes(), valid, ids, pack(np.diff(owner[hot_places], prepend=0)), pack(number), pack(to))
        out = [(texts[0][0], texts[0][1], "rows", payload)]
        for q in np.unique(to).tolist():
            own = np.flatnonzero(to == q)
            out.append((q, texts[0][1], "hot", joined(name[own].astype("<i8").tobytes(), names[codes[at[own]]].astype("<i8").tobytes(), pack(times[own]), here[at[own]].tobytes())))

        u, v = names[codes[longer - 2]], names[codes[longer - 1]]
        to, name = _dealt((mix(u.astype(np.uint64)) + v.astype(np.uint64)).astype(np.int64), parts)
        after = _next(names)[codes[longer]]
        bits = np.clip(np.round(-np.log2(here[longer]) * 1024), 0, 65535).astype("<u2")
        own_order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[own_order], np.arange(parts + 1))
        for q in np.flatnonzero(np.diff(cuts)).tolist():
            own = own_order[cuts[q] : cuts[q + 1]]
            doc = owner[longer[own]]
            out.append((q, texts[0][1], "longer", joined(
                name[own].tobytes(), _low(after[own], 3).tobytes(), bits[own].tobytes(), pack(np.diff(doc, prepend=0)), np.packbits(taught[doc]).tobytes(),
            )))
        return _table(out)

    return run


def _longer(states: dict[int, tuple[int, int]], gain: float):
    """Counts, tests and scores the contexts of two words of a part; a sum per text goes back."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
        out = [r for r in rows if r[2] == "rows"]
        asked = [r for r in rows if r[2] == "hot"]
        if asked:
            contexts, number, seen, parent, row = _slice([r[3] for r in asked])
            n, t = np.array([states[c] for c in contexts.tolist()], float).T
            n, t = n[number], t[number]
            logs, at = np.log10(np.where(t > 0, (seen + t * parent) / np.maximum(n + t, 1), parent))[row], 0
            for r in asked:
                size = len(parted(r[3])[0]) // 8
                out.append((*r[:3], logs[at : at + size].tobytes()))
                at += size
        asked = [(r, parted(r[3])) for r in rows if r[2] == "longer"]
        if asked:
            context = np.concatenate([np.frombuffer(x[0], "<u4") for _, x in asked])
            following = np.concatenate([_named(x[1], 0, 3) for _, x in asked]).astype(np.uint64)
            parent = 2.0 ** (-np.concatenate([np.frombuffer(x[2], "<u2") for _, x in asked]).astype(float) / 1024)
            taught = np.concatenate([np.unpackbits(np.frombuffer(x[4], np.uint8), count=len(x[0]) // 4) for _, x in asked]).astype(float)
            keys, first, inverse = np.unique((context.astype(np.uint64) << np.uint64(32)) | following, return_index=True, return_inverse=True)
            seen = np.bincount(inverse, taught)
            number = np.unique(keys >> np.uint64(32), return_inverse=True)[1]
            total, kinds = _tested(number, seen, parent[first], gain)
            t = kinds[number][inverse]
            chance = np.where(t > 0, (seen[inverse] + t * parent) / np.maximum(total[number][inverse] + t, 1), parent)
            logs, at = np.log10(chance), 0
            for r, x in asked:
                doc = np.cumsum(unpack(x[3]), dtype=np.int64)
                kinds_of = np.unique(doc)
                out.append((*r[:3], joined(pack(kinds_of), np.bincount(doc, logs[at : at + len(doc)])[kinds_of].tobytes())))
                at += len(doc)
        return _table(out)

    return run


def _summed(table: pa.Table) -> pa.Table:
    rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
    sizes, known, base, score, valid, ids, owner, number, to = parted(next(r[3] for r in rows if r[2] == "rows"))
    score, owner, number, to = np.frombuffer(score).copy(), np.cumsum(unpack(owner), dtype=np.int64), unpack(number), unpack(to)
    logs = np.zeros(len(to))
    for part, _, kind, payload in rows:
        if kind == "longer":
            doc, sums = parted(payload)
            score[unpack(doc)] += np.frombuffer(sums)
        elif kind == "hot":
            logs[to == part] = np.frombuffer(payload)
    score += np.bincount(owner, logs[number], len(score))
    missing = ~np.frombuffer(valid, bool)
    return pa.table({
        "doc_id": pa.array(np.frombuffer(ids, "<i8"), mask=missing), "n_tokens": np.frombuffer(sizes, "<i8"), "n_known": np.frombuffer(known, "<i8"),
        "base_score": np.frombuffer(base), "score": score,
    })


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Frames made within give their shuffle files back as soon as their table is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _kinds_written(spark: SparkSession, rows: DataFrame) -> tuple[str, DataFrame]:
    """Packed rows as a table with a folder per kind, so that a kind can go when it has been used."""
    folder = shared_folder(spark, "kinds")
    rows.write.partitionBy("kind").parquet(folder)
    return folder, spark.read.schema(PACKED).parquet(folder).select("part", "block", "kind", "payload")


def _removed(spark: SparkSession, folder: str) -> None:
    """Remove an intermediate folder that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def score(
    documents: DataFrame, taught: Column, *, doc_id: str = "doc_id", text: str = "text", gain: float = GAIN, part_keys: int = PART_KEYS, shares: int = SHARES
) -> DataFrame:
    """Per row: tokens, those known, the log10 probability by word frequencies and that by the tree.

    ``taught`` is true for the rows to learn from. ``train_tokens`` is the number of their symbols.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(taught, F.lit(False)).alias("taught"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / 6 / part_keys))
    shares = max(shares, parts)
    with _shuffles_freed(spark):
        counted = rows.where("taught").select("text").mapInArrow(_counter(parts), PACKED).repartition(parts, "part")
        found = cut_lineage(counted.groupBy("part").applyInArrow(_totals(shares), "word bigint, n bigint, kinds bigint"))
    whole = found.where("word IS NULL").agg(F.sum("n"), F.sum("kinds")).first()
    tokens, kinds = whole[0] or 0, whole[1] or 0
    limit = max(tokens / shares, 1000)
    common = sorted((r.word, r.n) for r in found.where(F.col("n") > limit).where("word IS NOT NULL").collect())  # at most ``shares``
    hot, hot_counts = (np.array([c[i] for c in common], np.int64) for i in range(2))
    normal = tokens + 0.5 * (kinds + 1)

    with _shuffles_freed(spark):
        dealt = rows.mapInArrow(_splitter(parts, hot), PACKED).repartition(parts, "part")
        folder, met = _kinds_written(spark, dealt.groupBy("part").applyInArrow(_part_counter(hot, hot_counts, normal, limit), PACKED))
        states = _hot_states(met.where("kind = 'hot'"), gain) if common else {}
        tested = met.where("kind IN ('words', 'tests')").groupBy("part").applyInArrow(_tester(states, normal, gain), PACKED)
        # written before the blocks meet, so that the pairs and their shuffle are gone by then
        tested_folder, tested = _kinds_written(spark, tested)
        for kind in ("words", "tests", "hot"):
            _removed(spark, f"{folder}/kind={kind}")
        answered = tested.unionByName(met.where("kind IN ('texts', 'pairs')"))
        crowded = bool(common) and not met.where("kind = 'hot pairs'").isEmpty()
        scored = cut_lineage(answered.groupBy("block").applyInArrow(_scorer(parts, hot, normal, limit), PACKED))
        states = _hot_states(scored.where("kind = 'hot'"), gain) if crowded else {}
        for own in (folder, tested_folder):
            _removed(spark, own)
    scored = scored.repartition(parts, "part")
    final = scored.groupBy("part").applyInArrow(_longer(states, gain), PACKED).groupBy("block").applyInArrow(_summed, SCORED)
    return final.withColumn("train_tokens", F.lit(tokens).cast("bigint"))
