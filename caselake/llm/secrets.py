"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The field tags the tokens of each line (runs of letters and digits, or runs of
other signs) as outside, begin or inside of a secret.  It is trained on what
the patterns mark in a bounded sample of documents, and on the same lines with
the naming word left out or another value in place: so it learns shapes and
neighbours, not the patterns, and carries over to secrets that no pattern
names.  Every line of every text is decoded with the Viterbi algorithm.

Texts are tagged in pieces of bounded size, cut where no pattern can reach
across: at line ends, and at blanks between letters where a line is longer than
a piece.  A chain is a line or ``MAX_CHAIN`` tokens of it; the best
tags of a longer line are found over all its chains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .words import LETTERS, RUNS, SPACED, Words, mix, slices

#: Bound on the documents whose lines train the field, those of the smallest hash of doc_id.
MAX_TRAIN_DOCS = 20_000
#: Bound on the tokens of the training lines, half of them with a secret and half without; lines of the smallest hash.
MAX_TRAIN_TOKENS = 300_000
#: Text that is tagged at a time; a token takes some 300 bytes meanwhile.
TEXT_BYTES = 1 << 19
#: Most tokens of a chain; a longer line is several, through which the best way is found as through one.
MAX_CHAIN = 4096
_DIMS = 1 << 16
_NEVER = -1e4
_O, _B, _I = 0, 1, 2

# The patterns of known secrets, their kinds in output order, and least lengths.
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "crf")
_LEAST = {"assign": 12, "access": 18, "hex": 16}

SPANS = "array<struct<kind:string,start:int,end:int>>"


def _pattern_spans(data: np.ndarray, row_start: np.ndarray, row_end: np.ndarray) -> dict[str, list[tuple[int, int, int, int]]]:
    """Spans of each kind as (row, start, end, start of the secret itself), in bytes of the slice."""
    found: dict[str, list[tuple[int, int, int, int]]] = {k: [] for k in KINDS[:3]}
    is_hex = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], is_hex.astype(np.int8), [0]))))
    cuts = np.unique(row_start)
    for s, e in zip(edge[::2][edge[1::2] - edge[::2] >= _LEAST["hex"]], edge[1::2][edge[1::2] - edge[::2] >= _LEAST["hex"]]):
        inner = cuts[(cuts > s) & (cuts < e)]  # a run goes no further than its text
        for a, b in zip([s, *inner], [*inner, e]):
            if b - a >= _LEAST["hex"]:
                found["hex"].append((int(np.searchsorted(row_start, a, "right")) - 1, int(a), int(b), int(a)))
    raw = data.tobytes()
    for r in range(len(row_start)):
        a, b = int(row_start[r]), int(row_end[r])
        for m in _ASSIGN.finditer(raw, a, b):
            if m.end(2) - m.start(2) >= _LEAST["assign"]:
                found["assign"].append((r, m.start(), m.end(), m.start(2)))
        if raw.find(b"AKIA", a, b) >= 0:
            for m in _ACCESS.finditer(raw, a, b):
                if m.end() - m.start() >= _LEAST["access"]:
                    found["access"].append((r, m.start(), m.end(), m.start()))
    found["hex"] = [(_row(row_start, row_end, x[1]), *x[1:]) for x in found["hex"]]
    return found


def _row(row_start: np.ndarray, row_end: np.ndarray, at: int) -> int:
    """The row that holds a byte; empty rows at the same place hold nothing."""
    r = int(np.searchsorted(row_start, at, "right")) - 1
    while row_end[r] <= at:
        r -= 1
    return r


def _bucket(n: np.ndarray) -> np.ndarray:
    """0, 1, 2, 3-4, 5-8, ... as small numbers."""
    return np.ceil(np.log2(np.maximum(n, 0) + 1)).astype(np.int64)


def _shares(data: np.ndarray, row_start: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """The file feature of each row: the shares of digits and of signs in all its text."""
    digit, sign = (data >= 48) & (data <= 57), (SPACED[data] == 1) & (LETTERS[data] == 0)
    count = lambda x: np.array([np.count_nonzero(x[a:b]) for a, b in zip(row_start, row_end)], np.int64)
    size = np.maximum(count(SPACED[data]), 1)
    return _bucket(count(digit) * 64 / size) * 8 + np.minimum(_bucket(count(sign) * 64 / size), 7)


def _cuts(data: np.ndarray) -> list[int]:
    """Where a long text is cut into pieces: after the last line end within ``TEXT_BYTES``, else at its last blank between letters, else at the next of either."""
    plain = (LETTERS[data] == 1) & (data < 128)
    blank = np.zeros(len(data), bool)
    blank[1:-1] = (data[1:-1] == 32) & plain[:-2] & plain[2:]
    lines, blanks = np.flatnonzero(data == 10) + 1, np.flatnonzero(blank) + 1
    cuts = [0]
    while len(data) - cuts[-1] > TEXT_BYTES:
        last = [places[np.searchsorted(places, cuts[-1] + TEXT_BYTES, "right") - 1] if len(places) and places[0] <= cuts[-1] + TEXT_BYTES else 0 for places in (lines, blanks)]
        good = [c for c in last if c > cuts[-1]]
        if not good:
            good = sorted(int(places[k]) for places in (lines, blanks) if (k := np.searchsorted(places, cuts[-1], "right")) < len(places))
        if not good:
            break
        cuts.append(int(good[0]))
    return [*cuts, len(data)]


def _pieces(text: pa.Array) -> Iterator[tuple[pa.Array, int, np.ndarray, int]]:
    """Rows of ``text`` together, or a part of one long row: with the first row's number, the file features, and the characters before it."""
    for s, e in slices(text, TEXT_BYTES):
        part = text.slice(s, e - s)
        w = Words.bounds(part)
        file = _shares(*w)
        if e - s > 1 or len(w[0]) <= TEXT_BYTES:
            yield part, s, file, 0
            continue
        cuts, chars = _cuts(w[0]), 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pa.array([w[0][a:b].tobytes()], pa.large_binary()).cast(pa.large_string()), s, file, chars
            chars += int(np.count_nonzero((w[0][a:b] & 0xC0) != 0x80))


class _Lines:
    """Tokens of some texts with their features, and the token ranges of their chains."""

    def __init__(self, text: pa.Array, file: np.ndarray) -> None:
        self.words = w = Words(text, lower=True, classes=RUNS)
        raw, n = w.text, len(w.start)
        self.row = w.row_of_word()
        if not n:
            self.features, self.line_first, self.line_size = np.zeros((0, 12), np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.hash, self.goes_on, self.is_gone_on = np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
            return
        size = w.end - w.start
        digit, lower, upper = (raw >= 48) & (raw <= 57), (raw >= 97) & (raw <= 122), (raw >= 65) & (raw <= 90)
        kind = np.where(digit, 1, np.where(lower, 2, np.where(upper, 3, np.where(LETTERS[raw] == 1, 4, 5)))).astype(np.int8)
        turn = np.concatenate(([False], kind[1:] != kind[:-1]))
        inside = ~w.outside
        total = lambda x: np.add.reduceat((x & inside).astype(np.int32), w.start)
        digits, lowers, uppers, turns = total(digit), total(lower), total(upper), total(turn)
        hexes = total(digit | ((raw >= 97) & (raw <= 102)))
        length = np.minimum(_bucket(size), 9)
        has = (digits > 0) + 2 * (lowers > 0) + 4 * (uppers > 0) + 8 * (digits + lowers + uppers < size)
        shape = has * 10 + length
        h = w.hashes()
        start_byte = np.searchsorted(w.row_start, w.start, "right")
        ends_line = np.add.reduceat((raw == 10).astype(np.int32), w.start) > 0
        first = np.concatenate(([True], ends_line[:-1] | (start_byte[1:] != start_byte[:-1])))
        word = np.where(size <= 24, (h >> np.uint64(40)).astype(np.int64), 1)
        before = lambda x, k: np.where(_far(first, k), -1, np.concatenate((np.full(k, -1), x))[:n])
        after = np.where(np.append(first[1:], True), -1, np.append(x := shape, -1)[1 : n + 1])
        opening = (raw[w.start].astype(np.int64) << 8) + raw[np.minimum(w.start + 1, len(raw) - 1)]
        columns = (
            lambda: shape,
            lambda: np.minimum(turns * 4 // np.maximum(size, 1), 4) * 100 + np.minimum(digits * 8 // size, 8) * 10 + length,
            lambda: (hexes == size) * 10 + length,
            lambda: opening * 10 + length,
            lambda: word,
            lambda: before(word, 1),
            lambda: before(word, 2),
            lambda: before(word, 3),
            lambda: before(x, 1) * 1000 + shape,
            lambda: after * 1000 + shape,
            lambda: file[self.row] * 1000 + shape,
            lambda: np.minimum(_bucket(size - turns), 9) * 100 + np.minimum(uppers * 8 // size, 8) * 10 + length,
        )
        self.features = np.empty((n, len(columns)), np.uint16)
        for i, column in enumerate(columns):  # one at a time, so that no more than one is held wide
            self.features[:, i] = mix(column().astype(np.int64).view(np.uint64), i) & np.uint64(_DIMS - 1)
        line = np.cumsum(first) - 1
        place = np.arange(n) - np.flatnonzero(first)[line]
        first |= place % MAX_CHAIN == 0
        self.line_first = np.flatnonzero(first)
        #: chains that go on a line, and those that one goes on from
        self.goes_on = place[self.line_first] > 0
        self.is_gone_on = np.append(self.goes_on[1:], False)
        self.line_size = np.diff(np.append(self.line_first, n))
        #: a hash of each chain's words
        self.hash = np.add.reduceat(mix(h, 77) * (2 * (place % MAX_CHAIN).astype(np.uint64) + np.uint64(1)), self.line_first)


def _far(first: np.ndarray, k: int) -> np.ndarray:
    """Tokens that have fewer than k tokens before them in their line."""
    out = first.copy()
    for j in range(1, k):
        out[j:] |= first[:-j]
    return out


class Field:
    """Emission weights by feature and tag, and transition weights."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit.astype(np.float32), move.astype(np.float32)

    def decode(self, lines: _Lines) -> np.ndarray:
        """The best tag of every token: Viterbi over all chains at once, longest first.

        A chain that goes on a longer line is worked out for each tag that the one
        before may end in; which one it is, is settled line by line afterwards.
        """
        n = len(lines.row)
        score = np.zeros((n, 3), np.float32)
        for f in range(lines.features.shape[1]):
            score += self.emit[lines.features[:, f]]
        score[1:][lines.words.start[1:] > lines.words.end[:-1], _I] = _NEVER  # no secret goes on across white space
        tag = np.zeros(n, np.int8)
        alone, parts = np.flatnonzero(~lines.goes_on & ~lines.is_gone_on), np.flatnonzero(lines.goes_on | lines.is_gone_on)
        begin = score[lines.line_first] + np.array([0, 0, _NEVER], np.float32)
        for last, back in self._ways(lines, alone, begin[alone], score):
            self._follow(lines, alone, last.argmax(1), back, tag)
        if len(parts):
            ways = []
            for entry in range(3):
                enter = np.where(lines.goes_on[parts, None], self.move[entry] + score[lines.line_first[parts]], begin[parts])
                ways += self._ways(lines, parts, enter, score)
            whole = np.stack([last for last, _ in ways], 1)  # chain, tag before, last tag
            came = np.zeros((len(parts), 3), np.int64)
            total = np.zeros(3)
            for c in range(len(parts)):
                paths = (total[:, None] if lines.goes_on[parts[c]] else 0) + whole[c].astype(np.float64)
                came[c], total = paths.argmax(0), paths.max(0)
                total = total - total.max()
                whole[c, 0] = total  # from here on the best up to here
            end, entry = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
            for c in range(len(parts) - 1, -1, -1):
                follows = c + 1 < len(parts) and lines.goes_on[parts[c + 1]]
                end[c] = entry[c + 1] if follows else whole[c, 0].argmax()
                entry[c] = came[c, end[c]]
            for e in range(3):
                mine = np.flatnonzero(entry == e)
                self._follow(lines, parts[mine], end[mine], ways[e][1], tag)
        return tag

    def _ways(self, lines: _Lines, chains: np.ndarray, begin: np.ndarray, score: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The scores of the best ways to the last tags of some chains from the scores of their first ones, and the tags before on these ways."""
        order = np.argsort(-lines.line_size[chains], kind="stable")
        first, size = lines.line_first[chains][order], lines.line_size[chains][order]
        back = np.zeros((len(score), 3), np.int8)
        best = begin[order]
        most = int(size.max(initial=0))
        live = np.searchsorted(-size, -np.arange(most + 1), "left")  # chains of more than t tokens
        for t in range(1, most):
            k = live[t]
            paths = best[:k, :, None] + self.move
            at = first[:k] + t
            back[at] = paths.argmax(1)
            best[:k] = paths.max(1) + score[at]
        out = np.empty_like(best)
        out[order] = best
        yield out, back

    def _follow(self, lines: _Lines, chains: np.ndarray, end: np.ndarray, back: np.ndarray, tag: np.ndarray) -> None:
        """Write the tags of some chains from their last ones."""
        order = np.argsort(-lines.line_size[chains], kind="stable")
        first, size, now = lines.line_first[chains][order], lines.line_size[chains][order], end[order].copy()
        tag[first + size - 1] = now
        most = int(size.max(initial=0))
        live = np.searchsorted(-size, -np.arange(most + 1), "left")
        for t in range(most - 1, 0, -1):
            k = live[t]
            now[:k] = back[first[:k] + t, now[:k]]
            tag[first[:k] + t - 1] = now[:k]


def _forward_backward(score: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log weights of all ways to and from each tag (place, chain, tag), and of each chain; ``score`` is (chain, place, tag)."""
    n, wide = mask.shape
    fold = lambda x, axis: (m := x.max(axis)) + np.log(np.exp(x - np.expand_dims(m, axis)).sum(axis))
    alpha, beta = np.zeros((wide, n, 3)), np.zeros((wide, n, 3))
    alpha[0] = score[:, 0] + np.array([0.0, 0.0, _NEVER])
    for t in range(1, wide):
        alpha[t] = np.where(mask[:, t, None], fold(alpha[t - 1][:, :, None] + move, 1) + score[:, t], alpha[t - 1])
    for t in range(wide - 2, -1, -1):
        beta[t] = np.where(mask[:, t + 1, None], fold(move + (score[:, t + 1] + beta[t + 1])[:, None, :], 2), beta[t + 1])
    return alpha, beta, fold(alpha[-1], 1)


def _train(lines: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.2, decay: float = 1e-5, batch: int = 128) -> Field:
    """AdaGrad on the field's negative log-likelihood (forward-backward on batches of lines of like length)."""
    emit, move = np.zeros((_DIMS, 3)), np.zeros((3, 3))
    move[_O, _I] = _NEVER
    g_emit, g_move = np.full((_DIMS, 3), 1e-4), np.full((3, 3), 1e-4)
    rng = np.random.default_rng(11)
    lines = sorted(lines, key=lambda x: len(x[1]))
    groups, at = [], 0
    while at < len(lines):  # padded batches of at most 64 tokens a line, or a single line
        n = max(1, min(batch, 64 * batch // len(lines[min(at + batch, len(lines)) - 1][1])))
        groups.append(lines[at : at + n])
        at += n
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            group = groups[g]
            n, length = len(group), np.array([len(y) for _, y in group])
            wide = int(length.max())
            mask = np.arange(wide)[None] < length[:, None]
            x, y = np.zeros((n, wide, group[0][0].shape[1]), np.int64), np.zeros((n, wide), np.int64)
            x[mask], y[mask] = np.concatenate([a for a, _ in group]), np.concatenate([b for _, b in group])
            score = emit[x].sum(2)
            alpha, beta, z = _forward_backward(score, mask, move)
            d = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2)
            d[np.arange(n)[:, None], np.arange(wide)[None], y] -= 1
            d = d[mask] / n
            used, slot = np.unique(x[mask], return_inverse=True)
            d_emit = np.zeros((len(used), 3))
            np.add.at(d_emit, slot.reshape(-1, x.shape[2]), d[:, None, :])
            d_emit += decay * emit[used]
            d_move = np.zeros((3, 3))
            for t in range(1, wide):
                both = mask[:, t]
                p = np.exp(alpha[t - 1][both][:, :, None] + move + (score[both, t] + beta[t][both])[:, None, :] - z[both][:, None, None])
                d_move += p.sum(0)
                np.add.at(d_move, (y[both, t - 1], y[both, t]), -1)
            d_move /= n
            g_emit[used] += d_emit**2
            g_move += d_move**2
            emit[used] -= rate * d_emit / np.sqrt(g_emit[used])
            step = rate * d_move / np.sqrt(g_move)
            step[_O, _I] = 0
            move -= step
    return Field(emit, move)


# Alphabets of the values that are put in place of a secret in training, and what stands where its naming word was.
_ALPHABETS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    b"abcdefghijklmnopqrstuvwxyz0123456789",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
)
_UNNAMED = (b"", b"\"", b"= ", b": ", b"'", b"with ")


def _variants(line: bytes, span: int, secret: int, end: int, seed: int) -> list[tuple[bytes, int, int]]:
    """A line with a secret, then without its naming word and with other values: each with the secret's start and end."""
    rng = np.random.default_rng(seed)
    out = [(line, secret, end)]
    for named in (True, False):
        for drawn in (False, True, True):
            if named and not drawn:
                continue
            value = bytes(rng.choice(np.frombuffer(_ALPHABETS[rng.integers(len(_ALPHABETS))], np.uint8), rng.integers(16, 49))) if drawn else line[secret:end]
            before = line[:secret] if named else line[:span] + _UNNAMED[rng.integers(len(_UNNAMED))]
            out.append((before + value + line[end:], len(before), len(before) + len(value)))
    return out


def _marked(lines: _Lines, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tags of all tokens: begin and inside for the byte ranges ``spans``."""
    w = lines.words
    tag = np.zeros(len(w.start), np.int8)
    for start, end in spans:
        a, z = np.searchsorted(w.end, start, "right"), np.searchsorted(w.start, end)
        tag[a:z] = _I
        tag[a:z][:1] = _B
    return tag


def _lessons(text: pa.Array) -> Iterator[tuple[_Lines, np.ndarray, np.ndarray, list]]:
    """Lines of some texts, their tags, which chains hold a secret, and each pattern's (span start, secret start, end, file feature)."""
    for part, _, file, _ in _pieces(text):
        lines = _Lines(part, file)
        w = lines.words
        row_end = np.append(w.row_start[1:], len(w.data))
        found = [(a, secret, b, int(file[r])) for spans in _pattern_spans(w.text, w.row_start, row_end).values() for r, a, b, secret in spans]
        tag = _marked(lines, [x[1:3] for x in found])
        hot = np.add.reduceat(tag, lines.line_first) > 0 if len(tag) else np.zeros(0, bool)
        yield lines, tag, hot, found


def fit_secrets(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_tokens: int = MAX_TRAIN_TOKENS) -> Field:
    """Train on the patterns' spans in at most ``max_docs`` documents of doc_id and text.

    Their different lines with a secret, and those without one, each up to half
    of ``max_tokens`` tokens in the order of a hash, are the lessons; a line with
    a secret also teaches with its naming word left out and with other values.
    Without documents, or without secrets in them, the field tags nothing.
    """
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    sample = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lines, _, hot, _ in _lessons(b.column(0)):
                columns = [pa.array(hot), pa.array(lines.hash.view(np.int64)), pa.array(lines.line_size.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["hot", "hash", "n"])

    sizes = rows.mapInArrow(measure, "hot boolean, hash long, n int").groupBy("hot", "hash").agg(F.max("n").alias("n"))
    most: dict[bool, int] = {}
    for hot in (True, False):  # no more rows than tokens, 12 bytes each
        got = sizes.filter(F.col("hot") == hot).orderBy("hash").limit(max_tokens // 2).select("hash", "n").toArrow()
        taken = got["hash"].to_numpy()[np.cumsum(got["n"].to_numpy(), dtype=np.int64) <= max_tokens // 2]
        most[hot] = int(taken.max()) if len(taken) else -(1 << 63)

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lines, tag, hot, found in _lessons(b.column(0)):
                out: list[tuple[int, int, bytes, bytes]] = []
                number = lines.hash.view(np.int64)
                pick = np.flatnonzero((number <= most[False]) & ~hot | (number <= most[True]) & hot)
                for i in pick:
                    at = slice(lines.line_first[i], lines.line_first[i] + lines.line_size[i])
                    out.append((int(number[i]), 0, tag[at].tobytes(), lines.features[at].tobytes()))
                w = lines.words
                taught = set(pick[hot[pick]].tolist())
                for span, secret, end, file in found:
                    token = int(np.searchsorted(w.end, secret, "right"))
                    i = int(np.searchsorted(lines.line_first, token, "right")) - 1
                    if i not in taught:
                        continue
                    low, high = int(w.start[lines.line_first[i]]), int(w.end[lines.line_first[i] + lines.line_size[i] - 1])
                    low, high = min(low, int(span)), max(high, int(end))
                    others = _variants(w.text[low:high].tobytes(), int(span) - low, int(secret) - low, int(end) - low, int(number[i]) & 0x7FFFFFFF)[1:]
                    for k, (line, a, z) in enumerate(others, 1):
                        x = _Lines(pa.array([line], pa.large_binary()).cast(pa.large_string()), np.array([file]))
                        t = _marked(x, [(a, z)])[:MAX_CHAIN]
                        out.append((int(number[i]), k, t.tobytes(), x.features[:MAX_CHAIN].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["hash", "variant", "tags", "features"])

    lessons = rows.mapInArrow(teach, "hash long, variant int, tags binary, features binary").groupBy("hash", "variant").agg(F.min(F.struct("tags", "features")).alias("x"))
    # tags and features stay packed, one and two bytes each, until a batch of lines needs them
    got = lessons.select("x.tags", "x.features").toArrow()
    lines = sorted(zip(got["tags"].to_pylist(), got["features"].to_pylist()))
    if not any(any(t) for t, _ in lines):
        return Field(np.zeros((_DIMS, 3)) + np.array([0.0, _NEVER, _NEVER]), np.zeros((3, 3)))
    return _train([(np.frombuffer(f, np.uint16).reshape(len(t), -1), np.frombuffer(t, np.int8)) for t, f in lines])


def _crf_spans(lines: _Lines, tag: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, start, end) of each begin and the insides after it, without signs at its ends."""
    w = lines.words
    out = []
    for i in np.flatnonzero(tag == _B):
        j = i + 1
        while j < len(tag) and tag[j] == _I and lines.row[j] == lines.row[i]:
            j += 1
        held = [k for k in range(i, j) if LETTERS[w.text[w.start[k]]]]
        if held:
            out.append((int(lines.row[i]), int(w.start[held[0]]), int(w.end[held[-1]])))
    return out


def _scan(text: pa.Array, field: Field) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of some rows each time: row, kind, start and end in characters and in bytes of the row; ordered by row, start and kind."""
    before: dict[int, int] = {}
    for part, row, file, chars_before in _pieces(text):
        lines = _Lines(part, file)
        w = lines.words
        row_end = np.append(w.row_start[1:], len(w.data))
        base = _pattern_spans(w.text, w.row_start, row_end)
        spans = [(r, a, KINDS.index(k), b) for k, x in base.items() for r, a, b, _ in x]
        taken = sorted((a, b) for _, a, _, b in spans)
        lows = np.array([a for a, _ in taken], np.int64)
        highs = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else lows
        for r, a, b in _crf_spans(lines, field.decode(lines)):
            k = int(np.searchsorted(lows, b))
            if k == 0 or highs[k - 1] <= a:
                spans.append((r, a, 3, b))
        at = np.array(sorted(spans), np.int64).reshape(-1, 4)
        chars = np.concatenate(([0], np.cumsum((w.text & 0xC0) != 0x80, dtype=np.int64)))
        low, done = w.row_start[at[:, 0]], before.get(row, 0) if len(w.row_start) == 1 else 0
        yield row + at[:, 0], at[:, 2], chars[at[:, 1]] - chars[low] + chars_before, chars[at[:, 3]] - chars[low] + chars_before, at[:, 1] - low + done, at[:, 3] - low + done
        if len(w.row_start) == 1:
            before[row] = done + len(w.data)


def _all_spans(text: pa.Array, field: Field) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*_scan(text, field))] or [np.zeros(0, np.int64)] * 6


def find_secrets(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with a column secrets: kind, start and end (code points, end exclusive).

    Kinds are assign, access and hex for the patterns, leftmost and without
    overlap within a kind, and crf for what the field adds; a span of the field
    that touches one of a pattern is left out.  Spans are ordered by start, then
    by kind in that order.  A null or empty text has none.  A column named
    secrets is replaced; all others, of any name, stay.
    """

    @F.arrow_udf(SPANS)
    def scan(text: pa.Array) -> pa.Array:
        row, kind, start, end, _, _ = _all_spans(text, field)
        names = pa.DictionaryArray.from_arrays(pa.array(kind.astype(np.int8)), pa.array(KINDS)).cast(pa.string())
        struct = pa.StructArray.from_arrays([names, pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(text) + 1)).astype(np.int32)), struct)

    return docs.withColumn("secrets", scan("text"))


def mask_secrets(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of every text replaced by ``mark``; overlapping spans become one mark.

    Texts are scanned and masked in one pass.  A null text stays null.  No row is
    dropped, and no other column changes.
    """

    @F.arrow_udf("string")
    def mask(text: pa.Array) -> pa.Array:
        row, _, _, _, start, end = _all_spans(text, field)
        hit, first = np.unique(row, return_index=True)
        if not len(hit):
            return text
        out, at = [], 0
        for r, s, e in zip(hit.tolist(), first.tolist(), np.append(first[1:], len(row)).tolist()):
            out.append(text.slice(at, r - at))
            raw, parts, upto = text[r].as_py().encode(), [], 0
            for a, b in zip(start[s:e].tolist(), end[s:e].tolist()):
                if a >= upto:
                    parts += [raw[upto:a], mark.encode()]
                upto = max(upto, b)
            out.append(pa.array([b"".join([*parts, raw[upto:]]).decode()], text.type))
            at = r + 1
        return pa.concat_arrays([*out, text.slice(at)])

    return docs.withColumn("text", mask("text"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document, and a digest of those that the patterns alone find."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, fit_secrets(docs)).select("doc_id", "secrets")
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("secrets", lambda x: x["kind"] != "crf")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", line), ",").alias("spans"),
        count("crf").alias("n_crf"),
    )
