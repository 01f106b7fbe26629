"""Byte-pair token counts of every prefix, by dynamic programming.

Two neighbouring tokens stand in an encoding exactly if encoding their bytes together
gives the two back, and a row of tokens is an encoding exactly if all its neighbours do.
So the encoding of a prefix is that of a shorter one plus one token, and there is only
one such token: a pass from left to right finds the last token and the number of tokens
at each byte from those at the bytes before. Nothing is encoded twice, and every count
is there to be asked for afterwards.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np

LONG = 128  # bytes; longer pieces go one by one
CELLS = 1 << 21  # of a block's tables
NEVER = 1 << 40


def byte_signs() -> list[str]:
    """The sign that a byte-level vocabulary writes for each byte: printable ASCII and
    Latin-1 signs stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs, free = [""] * 256, 0x100
    for byte in range(256):
        signs[byte] = chr(byte) if byte in own else chr(free)
        free += byte not in own
    return signs


SIGNS = byte_signs()
BYTE_OF = np.zeros(0x200, np.uint8)
BYTE_OF[[ord(s) for s in SIGNS]] = np.arange(256)


class Merges:
    """A vocabulary's merges, as tables that numpy can look up."""

    def __init__(self, text: str) -> None:
        model = json.loads(text)["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix") if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges", "fuse_unk") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain byte-pair vocabulary: {model['type']}, {odd}")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        n = max(vocab.values()) + 1
        self.rank, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        for rank, (a, b) in enumerate(pairs):
            made = vocab[a + b]
            if self.rank[made] >= 0:
                raise ValueError(f"two merges make {a + b!r}")
            self.rank[made], self.left[made], self.right[made] = rank, vocab[a], vocab[b]
        made = np.flatnonzero(self.rank >= 0)
        keys = self.left[made] << 32 | self.right[made]
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(self.rank[made][order], NEVER)

        # A token that its own bytes are not encoded as never occurs.
        whole = np.array([len(s.removesuffix(end) if end else s) == 1 for s in vocab])
        ids = np.fromiter(vocab.values(), np.int64, len(vocab))
        valid = np.zeros(n, bool)
        valid[ids[whole & (self.rank[ids] < 0)]] = True
        stands = np.zeros(n, bool)
        stands[made] = self.neighbours(self.left[made], self.right[made], inside=True)
        for t in made[np.argsort(self.rank[made])]:
            valid[t] = stands[t] and valid[self.left[t]] and valid[self.right[t]]

        # A trie of the tokens' bytes; a node has a plain token, one that ends a word, or both.
        children: dict[int, int] = {}
        plain, ending = [-1], [-1]
        for sign, token in vocab.items():
            ends = bool(end) and sign.endswith(end)
            if not valid[token]:
                continue
            node = 0
            for byte in BYTE_OF[[ord(c) for c in (sign.removesuffix(end) if ends else sign)]].tolist():
                at = node << 8 | byte
                if at not in children:
                    children[at] = len(plain)
                    plain.append(-1)
                    ending.append(-1)
                node = children[at]
            if ends or not end:
                ending[node] = token
            if not ends:
                plain[node] = token
        self.children, self.plain_at, self.ending_at = children, plain, ending
        self.plain, self.ending = np.array(plain), np.array(ending)
        edges = np.array(sorted(children))
        self.edges = np.append(edges, np.iinfo(np.int64).max)
        self.below = np.array([children[e] for e in edges.tolist()] + [-1])
        self.known: dict[int, bool] = {}

    def neighbours(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """Whether no merge crosses from token ``a`` to token ``b``. ``inside`` asks it of
        the halves of one token, whose own merge does not count.

        The two are taken apart from their last merge backwards. While a part stands,
        a merge across must come before the merge that used the part up; at equal rank
        the one further left comes first.
        """
        x, y, out = a.copy(), b.copy(), np.ones(len(a), bool)
        limit = np.full(len(a), 2 * NEVER)
        live, first = np.arange(len(a)), inside
        while len(live):
            xs, ys = x[live], y[live]
            if not first:
                keys = xs << 32 | ys
                at = np.searchsorted(self.pair_keys, keys)
                across = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)
                bad = 2 * across < limit[live]
                out[live[bad]] = False
                live, xs, ys = live[~bad], xs[~bad], ys[~bad]
            first = False
            rx, ry = self.rank[xs], self.rank[ys]
            open_ = (rx >= 0) | (ry >= 0)
            live, xs, ys, rx, ry = live[open_], xs[open_], ys[open_], rx[open_], ry[open_]
            takes_left = rx > ry
            limit[live] = np.where(takes_left, 2 * rx, 2 * ry + 1)
            x[live] = np.where(takes_left, self.right[xs], xs)
            y[live] = np.where(takes_left, ys, self.left[ys])
        return out

    def _follows(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may follow; each distinct pair is judged once."""
        ok = last < 0
        some = np.flatnonzero(~ok)
        pairs, where = np.unique(last[some] << 32 | token[some], return_inverse=True)
        ok[some] = self.neighbours(pairs >> 32, pairs & 0xFFFFFFFF)[where]
        return ok

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For pieces of bytes behind one another: at each byte, the tokens of the piece
        up to and with it, were it to end there."""
        out = np.zeros(len(data), np.int32)
        sizes = np.diff(offsets)
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]
        at = 0
        while at < len(order):
            size = int(sizes[order[at]])
            if size > LONG:
                for piece in order[at:]:
                    out[offsets[piece] : offsets[piece + 1]] = self._one(
                        data[offsets[piece] : offsets[piece + 1]].tobytes()
                    )
                break
            wide = min(LONG, max(8, 1 << (size - 1).bit_length()))
            stop = int(np.searchsorted(sizes[order], wide, side="right"))
            stop = min(stop, at + CELLS // (wide + 1))
            self._block(data, offsets[order[at:stop]], sizes[order[at:stop]], out)
            at = stop
        return out

    def _block(
        self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, out: np.ndarray
    ) -> None:
        """``count`` for pieces of similar size at a time, sorted by size."""
        width = int(sizes[-1])
        last = np.full((len(starts), width + 1), -1, np.int64)
        counts = np.zeros((len(starts), width + 1), np.int32)
        for s in range(width):
            rows = np.arange(int(np.searchsorted(sizes, s, side="right")), len(starts))
            node = np.zeros(len(rows), np.int64)
            for k in range(s, width):
                inside = sizes[rows] > k
                rows, node = rows[inside], node[inside]
                keys = node << 8 | data[starts[rows] + k]
                at = np.searchsorted(self.edges, keys)
                there = self.edges[at] == keys
                rows, node = rows[there], self.below[at[there]]
                if not len(rows):
                    break
                for tokens, ends in ((self.plain[node], False), (self.ending[node], True)):
                    some = np.flatnonzero(tokens >= 0)
                    token, row = tokens[some], rows[some]
                    ok = self._follows(last[row, s], token)
                    token, row = token[ok], row[ok]
                    if ends:
                        out[starts[row] + k] = counts[row, s] + 1
                    else:
                        last[row, k + 1], counts[row, k + 1] = token, counts[row, s] + 1

    def _one(self, data: bytes) -> np.ndarray:
        """``count`` for one long piece."""
        n = len(data)
        last, counts, out = [-1] * (n + 1), [0] * (n + 1), [0] * n
        children, plain, ending = self.children, self.plain_at, self.ending_at
        for s in range(n):
            node, before, count = 0, last[s], counts[s] + 1
            for k in range(s, n):
                node = children.get(node << 8 | data[k], -1)
                if node < 0:
                    break
                token = plain[node]
                if token >= 0 and self._may(before, token):
                    last[k + 1], counts[k + 1] = token, count
                token = ending[node]
                if token >= 0 and self._may(before, token):
                    out[k] = count
        return np.array(out, np.int32)

    def _may(self, last: int, token: int) -> bool:
        if last < 0:
            return True
        key = last << 32 | token
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= 1 << 20:
                self.known.clear()
            known = bool(self.neighbours(np.array([last]), np.array([token]))[0])
            self.known[key] = known
        return known


def flat(pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of pieces written in byte signs."""
    offsets = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)), out=offsets[1:])
    return BYTE_OF[np.frombuffer("".join(pieces).encode("utf-16-le"), "<u2")], offsets
