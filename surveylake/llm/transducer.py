"""A byte-level BPE vocabulary as a finite-state transducer that is compiled as texts need it."""

from __future__ import annotations

import json
from array import array

import numpy as np

from surveylake.llm.common import worker_state
from surveylake.llm.inthash import IntHash
from surveylake.llm.pretokens import cut

#: Bytes of a chunk; all chunks of a slice take their steps side by side.
CHUNK = 128
#: States beyond which the compiled part is dropped and begun anew, so that memory stays bounded.
MAX_STATES = 3 << 17
#: Pairs of tokens beyond which what is known of them is dropped as well.
MAX_FITS = 1 << 19
#: Rounds of entry states that are tried for the chunks of a long piece before the rest is carried on in order.
ROUNDS = 32
_ID = 20  # bits of a token id or a trie node
_REL = 512  # more than the tokens that a state looks back over
_NEVER = 1 << 60


def printable_bytes() -> dict[str, int]:
    """The characters by which vocabulary files write bytes: itself if printable, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Transducer:
    """Reads bytes, and says at each how the number of tokens changes and which token ends there.

    After a prefix, the last token of its encoding is the one token ending there that may follow the last token of
    what lies before it. A state holds, for each start from which some token may still run on, the place in the
    trie of tokens, the last token before that start, and the tokens emitted since. A transition is annotated with
    the change of the token count, which is negative where a byte fuses earlier tokens. Cuts between pieces lead
    back to the first state, so that the state map of a chunk that holds a cut is constant.
    """

    def __init__(self, file: bytes):
        model = json.loads(file)
        kind, before = model["model"], model["pre_tokenizer"] or {}
        if kind["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or model["normalizer"]:
            raise ValueError("only byte-level BPE vocabularies without normalising are compiled")
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        as_byte = printable_bytes()
        names = {n: i for n, i in kind["vocab"].items() if n not in self.special}
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(kind["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[names[left] << _ID | names[right]] = (rank, names[left + right])
        self.bytes = {i: bytes(as_byte[c] for c in n) for n, i in names.items()}
        if max(map(len, self.bytes.values()), default=0) >= _REL or max(self.bytes, default=0) + 1 >= 1 << _ID:
            raise ValueError("the vocabulary's tokens are too long or too many for the packed states")
        self.parts = {token: (*divmod(key, 1 << _ID), rank) for key, (rank, token) in self.pairs.items()}
        self.edges: dict[int, list[tuple[int, int]]] = {}
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [False]
        for number, word in self.bytes.items():
            node = 0
            for byte in word:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token[node] = number
        self._clear()

    def _clear(self) -> None:
        self.fits: dict[int, bool] = {}
        self.numbers: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.ends: list[int] = []
        self.hops: dict[int, int] = {}
        self.table = IntHash(16)
        self._number(array("q", [self._pack(0, -1, 0)]), 0)

    @staticmethod
    def _pack(node: int, last: int, since: int) -> int:
        return (node << _ID | last + 1) * 2 * _REL + since + _REL

    def _number(self, entries: array, token: int) -> int:
        key = entries.tobytes()
        if key not in self.numbers:
            self.numbers[key] = len(self.keys)
            self.keys.append(key)
            self.ends.append(token)
        return self.numbers[key]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at the left (0) or right (1) edge of a token while it is merged, each with the rank that ends it."""
        key = token << 1 | side
        if key not in self.edges:
            found, ends = [], _NEVER
            while token in self.parts:
                found.append((token, ends))
                ends, token = self.parts[token][2], self.parts[token][side]
            self.edges[key] = [(token, ends), *reversed(found)]
        return self.edges[key]

    def _fits(self, last: int, token: int) -> bool:
        """Whether the token may follow the last one. -1: the token begins a piece.

        Both are merged side by side, each by its own ranks; the token fits if no pair across the border is due
        before one of the pair's tokens is merged on its own side. Of equal ranks the leftmost is due first.
        """
        if last < 0:
            return True
        key = last << _ID | token
        if key not in self.fits:
            left, right = iter(self._edge(last, 1)), iter(self._edge(token, 0))
            (a, a_ends), (b, b_ends) = next(left), next(right)
            fits = None
            while fits is None:
                rank = self.pairs.get(a << _ID | b, (_NEVER, 0))[0]
                if rank < a_ends and rank <= b_ends and rank < _NEVER:
                    fits = False
                elif a_ends == b_ends == _NEVER:
                    fits = True
                elif a_ends <= b_ends:
                    a, a_ends = next(left)
                else:
                    b, b_ends = next(right)
            self.fits[key] = fits
        return self.fits[key]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the change of the token count: compiles one transition."""
        held, token, change = [], -1, 0
        for entry in memoryview(self.keys[state]).cast("q"):
            place, since = divmod(entry, 2 * _REL)
            node, last = place >> _ID, (place & (1 << _ID) - 1) - 1
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            if token < 0 and self.token[node] >= 0 and self._fits(last, self.token[node]):
                token, change = self.token[node], 1 - (since - _REL)
            if self.inner[node]:
                held.append((node, last, since - _REL))
        packed = array("q", [self._pack(node, last, since + change) for node, last, since in held])
        packed.append(self._pack(0, token, 0))
        return self._number(packed, token), change

    def _advance(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """One step of many chunks: next states and changes, packed; transitions met for the first time are compiled."""
        keys = states << 8 | data
        found = self.table.get(keys)
        if found.min(initial=0) < 0:
            new = np.unique(keys[found < 0])
            made = [self.step(k >> 8, k & 255) for k in new.tolist()]
            self.table.insert(new, np.array([state << 16 | change + _REL for state, change in made]))
            found = self.table.get(keys)
        return found

    def run(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state after each byte and the change of the token count at each byte.

        The data is cut into chunks of equal length that run side by side. What follows the first cut of a chunk
        does not depend on the state it is entered in: that part of the map is found first. The heads then run
        from the end of the chunk before. Where chunks without a cut follow each other, inside a long piece, their
        maps are composed by `_entries`, and the chunks run from the states found.
        """
        if len(self.keys) > MAX_STATES or len(self.fits) > MAX_FITS:
            self._clear()
        size = len(data)
        chunks = -(-size // CHUNK)
        grid, flags = np.zeros(chunks * CHUNK, np.int64), np.ones(chunks * CHUNK, bool)  # padding: pieces of a byte
        grid[:size], flags[:size] = data, cuts
        grid, flags = (np.ascontiguousarray(x.reshape(chunks, CHUNK).T) for x in (grid, flags))
        steps = np.zeros((CHUNK, chunks), np.int64)  # state and change, packed
        head = np.where(flags.any(0), flags.argmax(0), CHUNK)
        now = np.zeros(chunks, np.int64)
        for place in range(CHUNK):
            now[flags[place]] = 0
            if place < CHUNK // 8:
                lanes = np.flatnonzero(head <= place)
                steps[place, lanes] = found = self._advance(now[lanes], grid[place, lanes])
                now[lanes] = found >> 16
            else:  # a chunk without a cut so far runs from its wrong state, and is done again below
                steps[place] = self._advance(now, grid[place])
                now = steps[place] >> 16
        known = head < CHUNK
        entered, ready = np.append(0, now[:-1]), np.append(True, known[:-1])
        lanes = np.flatnonzero(ready & (head > 0))
        ends = self._heads(lanes, entered[lanes], head, grid, steps)
        now[lanes] = np.where(known[lanes], now[lanes], ends)
        inner = np.flatnonzero(~ready & ~known)
        if len(inner):
            self._entries(inner, now, grid, steps)
        lanes = np.flatnonzero(~ready & known & (head > 0))
        self._heads(lanes, now[lanes - 1], head, grid, steps)
        steps = steps.T.reshape(-1)[:size]
        return steps >> 16, (steps & 0xFFFF) - _REL

    def _heads(self, lanes, now, head, grid, steps=None) -> np.ndarray:
        """Runs the heads of chunks from the given states, which it returns at their ends."""
        now = now.copy()
        active = np.arange(len(lanes))
        for place in range(CHUNK):
            active = active[head[lanes[active]] > place]
            if not len(active):
                break
            rows = lanes[active]
            found = self._advance(now[active], grid[place, rows])
            if steps is not None:
                steps[place, rows] = found
            now[active] = found >> 16
        return now

    def _entries(self, inner, now, grid, steps) -> None:
        """Runs the chunks without a cut that follow one such, and puts the state at the end of each into `now`.

        The map of a chunk is built for the states that can reach it: first the one in which the chunk before ends
        when begun anywhere, then those in which it ends from the states found for it, until no new one turns up.
        Ends soon no longer depend on the beginning, and chunks of equal bytes share their map, so this takes few
        rounds. The maps, as links from a state of a chunk to one of the next, are then composed by doubling, from the
        chunks whose entry is known. Chunks that this does not reach after `ROUNDS` are carried on in order.
        """
        whole = np.full(grid.shape[1], CHUNK)
        is_inner = np.zeros(grid.shape[1] + 1, bool)
        is_inner[inner] = True
        alike = np.zeros(grid.shape[1], np.int64)  # a chunk of the same bytes
        alike[inner] = inner[_first_equal(np.ascontiguousarray(grid[:, inner].T.astype(np.uint8)))]
        tried, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the maps: chunk and entry, packed, and the end
        nodes, new = np.zeros(0, np.int64), np.unique(inner << 32 | now[inner - 1])
        for _ in range(ROUNDS):
            nodes = np.union1d(nodes, new)
            lane, entry = new >> 32, new & 0xFFFFFFFF
            wanted = np.setdiff1d(alike[lane] << 32 | entry, tried)
            got = self._heads(wanted >> 32, wanted & 0xFFFFFFFF, whole, grid)
            order = np.argsort(np.append(tried, wanted))
            tried, ends = np.append(tried, wanted)[order], np.append(ends, got)[order]
            after = lane + 1 << 32 | ends[np.searchsorted(tried, alike[lane] << 32 | entry)]
            new = np.setdiff1d(after[is_inner[lane + 1]], nodes)
            if not len(new):
                break
        lane, entry = nodes >> 32, nodes & 0xFFFFFFFF
        end = ends[np.searchsorted(tried, alike[lane] << 32 | entry)]
        follows = lane + 1 << 32 | end
        jump = np.minimum(np.searchsorted(nodes, follows), len(nodes) - 1)
        jump = np.append(np.where(nodes[jump] == follows, jump, len(nodes)), len(nodes))  # the last leads nowhere
        reached = np.append(~is_inner[lane - 1] & (entry == now[lane - 1]), False)
        for _ in range(len(inner).bit_length()):
            reached[jump[np.flatnonzero(reached)]] = True
            jump = jump[jump]
        found = np.flatnonzero(reached[:-1])
        now[lane[found]] = end[found]
        self._heads(lane[found], entry[found], whole, grid, steps)
        for number in np.setdiff1d(inner, lane[found]).tolist():
            now[number] = self._one(number, now[number - 1], grid, steps)

    def _one(self, lane: int, now: int, grid, steps) -> int:
        """A chunk whose entry is only known once the chunk before is done."""
        now = int(now)
        for place, byte in enumerate(grid[:, lane].tolist()):
            key = now << 8 | byte
            if key not in self.hops:
                state, change = self.step(now, byte)
                self.hops[key] = state << 16 | change + _REL
            steps[place, lane] = self.hops[key]
            now = self.hops[key] >> 16
        return now

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        parts, owner, extra = self._parts(texts)
        total = np.bincount(extra, minlength=len(texts)) if len(extra) else np.zeros(len(texts), np.int64)
        data, cuts, firsts = cut(parts)
        if len(data):
            sums = np.concatenate([[0], np.cumsum(self.run(data, cuts)[1], dtype=np.int64)])
            per_part = sums[np.append(firsts[1:], len(data))] - sums[firsts]
            np.add.at(total, owner, per_part)
        return total.astype(np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts together, and where each text's begin (with the end as the last entry)."""
        parts, owner, extra = self._parts(texts)
        data, cuts, firsts = cut(parts)
        found, at = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(data):
            states, _ = self.run(data, cuts)
            token = np.asarray(self.ends, np.uint32)
            width = np.ones(max(self.bytes) + 1, np.int32)
            for number, word in self.bytes.items():
                width[number] = len(word)
            ends = np.zeros(len(data), bool)
            start = np.flatnonzero(cuts)
            place = np.append(start[1:], len(data)) - 1
            while len(place):
                ends[place] = True
                place = place - width[token[states[place]]]
                inside = place >= start
                place, start = place[inside], start[inside]
            at = np.flatnonzero(ends)
            found = token[states[at]]
        of = owner[np.searchsorted(firsts, at, "right") - 1] if len(at) else at
        if len(extra):  # special strings stand between the parts of their text
            gap = np.flatnonzero(np.diff(owner) == 0)
            before = np.searchsorted(at, firsts[gap + 1])
            found = np.insert(found, before, self._special_ids(texts))
            of = np.insert(of, before, owner[gap])
        return found, np.searchsorted(of, np.arange(len(texts) + 1))

    def _parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The texts cut at special strings, the text of each part, and a text for each special string."""
        names = list(self.special)
        if len(names) > 1:
            raise ValueError("only one special string is handled")
        pieces = [t.split(names[0]) if names and names[0] in t else [t] for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in pieces])
        extra = np.repeat(np.arange(len(texts)), [len(p) - 1 for p in pieces])
        return [x for p in pieces for x in p], owner, extra

    def _special_ids(self, texts: list[str]) -> np.ndarray:
        (name, number), *_ = self.special.items()
        return np.full(sum(t.count(name) for t in texts), number, np.uint32)


def _first_equal(rows: np.ndarray) -> np.ndarray:
    """For each row of bytes the place of the first that equals it."""
    whole = rows.view(np.dtype((np.void, rows.shape[1]))).ravel()
    _, first, same = np.unique(whole, return_index=True, return_inverse=True)
    return first[same]


def compiled(file: bytes) -> Transducer:
    """The vocabulary's transducer, which a worker keeps from task to task."""
    state = worker_state("tokens")
    key = ("transducer", hash(file))
    if key not in state:
        state[key] = Transducer(file)
    return state[key]
