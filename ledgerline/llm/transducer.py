"""A piece tokenizer as a deterministic transducer whose transitions carry token counts.

Byte-pair merging by scores gives each prefix of a text one encoding, and the encoding of a longer prefix is that of a shorter
one and one more token, which fits behind the shorter one's last token if merging the two alone leaves them as they are. So the
state after a character is: the longest suffix that begins some piece, and for each shorter suffix that does, the last token
before it and how many tokens fewer (or more) that place has. A transition carries the number of tokens by which the encoding
grows, which may be negative, as characters join. Between characters that no piece has side by side nothing is remembered,
so that the state after them is always the same: a place of rest.

States and transitions are made when a text first asks for them, in a table of a row for each state. Texts are read many
chunks at a time, one character of each in a step. Chunks are cut at places of rest where there are any near, so that the map
of a chunk from the state before it to the state after it needs one entry. A chunk in a stretch without rest (a long word, a
script without spaces) is entered by a guess, the state that the characters before it lead to; the prefix scan over the chunks
compares each guess with the true state after the chunk before, and where they differ the chunk is read again.
"""

from __future__ import annotations

import heapq
import itertools
from typing import NamedTuple

import numpy as np

SPACE, SEPARATOR = "▁", "\ud800"
NOTHING, FRESH = None, 0
CHUNK, LEAD, AHEAD, LONG, STATES = 512, 48, 256, 1 << 20, 200_000
#: A cell of the table: next state times SHIFT, plus the tokens gained and OFFSET.
SHIFT, OFFSET, UNKNOWN, PAGE = 32, 24, -1, 32


class Vocabulary(NamedTuple):
    scores: dict[str, float]  # of the pieces that merging may make


def vocabulary(path: str) -> Vocabulary:
    """Of a model file with byte fallback and no changes to texts but spaces as SPACE and one put before the text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    if model.encode(" a  b ", out_type=str) != model.encode(f"{SPACE}a{SPACE}{SPACE}b{SPACE}", out_type=str) or not any(model.is_byte(k) for k in range(n)):
        raise ValueError("a model that changes texts, or has no pieces for bytes")
    return Vocabulary({model.id_to_piece(k): model.get_score(k) for k in range(n) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))})


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """text in pieces: of the neighbours that are a piece together the best, and of equals the first, are joined until none is left."""
    part, right, left = list(text), [*range(1, len(text)), -1], [-1, *range(len(text) - 1)]
    queue: list[tuple[float, int, str]] = []

    def offer(a: int) -> None:
        if a >= 0 and right[a] >= 0 and (both := part[a] + part[right[a]]) in scores:
            heapq.heappush(queue, (-scores[both], a, both))

    for a in range(len(text) - 1):
        offer(a)
    while queue:
        _, a, both = heapq.heappop(queue)
        if not part[a] or right[a] < 0 or part[a] + part[right[a]] != both:
            continue
        b = right[a]
        part[a], part[b], right[a] = both, "", right[b]
        if right[b] >= 0:
            left[right[b]] = a
        offer(left[a])
        offer(a)
    return [p for p in part if p]


class Transducer:
    """count() gives the tokens of texts. At most `states` states are kept; beyond, the table is begun anew."""

    def __init__(self, vocabulary: Vocabulary, states: int = STATES):
        self.scores, self.most = vocabulary.scores, states
        pieces = [p for p in self.scores if len(p) > 1]
        self.opens = {p[:k] for p in self.scores for k in range(1, len(p))}
        beside = {(a, b) for p in pieces for a, b in itertools.pairwise(p)}
        joins = sorted({c for pair in beside for c in pair})
        # classes: 0 separator, 1 to 4 characters that are alone, by their tokens, then those that pieces join, the usual ones first
        joins.sort(key=lambda c: (not (c == SPACE or "a" <= c <= "z"), c))
        self.letters = ["", *[""] * 4, *joins]
        point = np.arange(0x110000)
        self.classes = (1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)).astype(np.uint16)
        for c in self.scores:
            if len(c) == 1:
                self.classes[ord(c)] = 1
        for k, c in enumerate(joins):
            self.classes[ord(c)] = 5 + k
        self.classes[ord(" ")], self.classes[ord(SEPARATOR)] = self.classes[ord(SPACE)], 0
        number = {c: 5 + k for k, c in enumerate(joins)}
        self.meets = np.zeros((len(self.letters),) * 2, bool)
        for a, b in beside:
            self.meets[number[a], number[b]] = True
        levels = sorted(self.scores.values(), reverse=True)
        self.tied = {a for a, b in itertools.pairwise(levels) if a == b}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.begin()

    def begin(self) -> None:
        """One state, FRESH: nothing is remembered."""
        self.known, self.number = [((), NOTHING)], {}
        self.fits.clear()
        self.page = np.zeros((1024, -(-len(self.letters) // PAGE)), np.int32)  # of each state and PAGE classes; page 0 is empty
        self.cells, self.pages = np.full((1024, PAGE), UNKNOWN, np.int32), 1

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that are joined last in making a piece, if scores fall from part to whole; else None."""
        if piece not in self.halves:
            inner = {p: x for k in range(len(piece)) for j in range(k + 1, len(piece) + 1) if (p := piece[k:j]) != piece and (x := self.scores.get(p)) is not None}
            parts, score = merged(piece, inner), self.scores[piece]
            sound = len(parts) == 2 and score not in self.tied and all(len(p) == 1 or self.scores[p] > score and self.split(p) for p in parts)
            self.halves[piece] = tuple(parts) if sound else None
        return self.halves[piece]

    def fit(self, a: str | None, b: str) -> bool:
        """Whether merging a and b together leaves them as they are."""
        if a is NOTHING:
            return True
        if (found := self.fits.get((a, b))) is None:
            found = self.fits[a, b] = self._fit(a, b)
        return found

    def _fit(self, a: str, b: str) -> bool:
        """Takes the two apart, what was joined last first: what meets at their border may not be joined before that. Of equals the first is."""
        scores, limit, behind, left, right = self.scores, -np.inf, False, a, b
        if any(len(x) > 1 and not self.split(x) for x in (a, b)):
            return merged(a + b, scores) == [a, b]
        while True:
            if (both := scores.get(left + right)) is not None and (both > limit or (both == limit and behind)):
                return False
            if len(left) == len(right) == 1:
                return True
            if len(right) == 1 or len(left) > 1 and scores[left] < scores[right]:
                limit, behind, left = scores[left], False, self.split(left)[1]
            else:
                limit, behind, right = scores[right], True, self.split(right)[0]

    def move(self, state: int, kind: int) -> None:
        """Makes the cell of the table for a state and a class of characters."""
        if kind < 5:
            cell = FRESH * SHIFT + kind + OFFSET
        else:
            suffixes, last = self.known[state]  # (suffix, last token before it, tokens there less tokens here); last token here
            c = self.letters[kind]
            if last is NOTHING or not self.beside(last[-1], c):
                suffixes, last = (), NOTHING
            grown = [(s + c, t, n) for s, t, n in suffixes] + [(c, last, 0)]
            token, gain = next((s, n + 1) for s, t, n in grown if s in self.scores and self.fit(t, s))
            key = (tuple((s, t, n - gain) for s, t, n in grown if s in self.opens), token)
            if (to := self.number.get(key)) is None:
                to = self.number[key] = len(self.known)
                self.known.append(key)
                if to == len(self.page):
                    self.page = np.concatenate((self.page, np.zeros_like(self.page)))
            cell = to * SHIFT + gain + OFFSET
        if not (own := self.page[state, kind // PAGE]):
            own = self.page[state, kind // PAGE] = self.pages
            self.pages += 1
            if own == len(self.cells):
                self.cells = np.concatenate((self.cells, np.full_like(self.cells, UNKNOWN)))
        self.cells[own, kind % PAGE] = cell

    def beside(self, a: str, c: str) -> bool:
        return bool(self.meets[self.classes[ord(a)], self.classes[ord(c)]])

    def read(self, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after and tokens gained in each stretch of characters, read side by side from the given states."""
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those still read are the first
        place, state, gained = starts[order].astype(np.int64), states[order].astype(np.int64), np.zeros(len(starts), np.int64)
        lengths = (ends - starts)[order]
        active = np.searchsorted(-lengths, -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
        for step, n in enumerate(active.tolist()):
            kind = kinds[place[:n] + step]
            high, low = kind >> 5, kind & (PAGE - 1)
            cells = self.cells[self.page[state[:n], high], low]
            if (new := np.flatnonzero(cells < 0)).size:
                for s, k in set(zip(state[new].tolist(), kind[new].tolist())):
                    self.move(s, k)
                cells[new] = self.cells[self.page[state[new], high[new]], low[new]]
            state[:n] = cells >> 5
            gained[:n] += (cells & (SHIFT - 1)) - OFFSET
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], gained[back]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; an empty one has none. Texts over LONG characters are read part by part."""
        found = np.zeros(len(texts), np.int64)
        waiting, held = [], 0
        for k, text in enumerate(texts):
            if len(text) > LONG:
                found[k] = self._long(text)
            else:
                waiting.append(k)
                held += len(text)
            if held > LONG or k == len(texts) - 1:
                found[waiting] = self._several([texts[j] for j in waiting])
                waiting, held = [], 0
        return found

    def _several(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > self.most:
            self.begin()
        kinds = self.kinds("".join(f"{SEPARATOR}{SPACE}{t}" if t else SEPARATOR for t in texts))
        return self._read(kinds, np.flatnonzero(kinds == 0), FRESH)[0]

    def _long(self, text: str) -> int:
        if len(self.known) > self.most:
            self.begin()
        total, state = 0, FRESH
        for at in range(0, len(text), LONG):
            part = text[at : at + LONG]
            gained, state = self._read(self.kinds(part if at else SPACE + part), np.zeros(1, np.int64), state)
            total += int(gained[0])
        return total

    def kinds(self, text: str) -> np.ndarray:
        return self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _read(self, kinds: np.ndarray, opening: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Tokens gained from each opening to the next, and the state at the end; state: that before the first character."""
        if not len(opening):
            return np.zeros(0, np.int64), state
        rest = np.concatenate(([0], 1 + np.flatnonzero(~self.meets[kinds[:-1], kinds[1:]]), [len(kinds)]))
        marks = np.arange(0, len(kinds), CHUNK)
        after = rest[np.searchsorted(rest, marks)]
        starts = np.unique(np.concatenate((opening, np.where(after - marks <= CHUNK, after, marks))))
        starts = starts[starts < len(kinds)]
        ends = np.append(starts[1:], len(kinds))
        entry = np.zeros(len(starts), np.int64)
        entry[0] = state
        guessed = np.flatnonzero(rest[np.searchsorted(rest, starts)] != starts)
        if len(guessed):
            entry[guessed], _ = self.read(kinds, np.maximum(starts[guessed] - LEAD, 0), starts[guessed], np.full(len(guessed), FRESH))
        leave, gained = self.read(kinds, starts, ends, entry)
        if len(guessed):
            self.compose(kinds, starts, ends, guessed, entry, leave, gained)
        return np.add.reduceat(gained, np.searchsorted(starts, opening)), int(leave[-1])

    def compose(self, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray, guessed: np.ndarray, entry: np.ndarray, leave: np.ndarray, gained: np.ndarray) -> None:
        """The prefix scan over chunk maps. Each guessed chunk has a map from the entries that it was read from; the scan follows
        the maps, and where one lacks an entry, this and the next AHEAD chunks are read from it side by side."""
        maps = {k: {int(entry[k]): (int(leave[k]), int(gained[k]))} for k in guessed.tolist()}
        left = guessed.tolist()
        while left:
            lacking, later = [], []
            held = -1  # the last chunk of the stretch whose scan has stopped
            for at, k in enumerate(left):
                if held == k - 1:  # the chunk before is not known yet
                    held = k
                    later.append(k)
                elif (state := int(leave[k - 1])) in maps[k]:
                    leave[k], gained[k] = maps[k][state]
                else:
                    lacking += [(j, state) for j in left[at : at + AHEAD] if j - k <= AHEAD and state not in maps[j]]
                    held = k
                    later.append(k)
            lacking = sorted(set(lacking))
            if lacking:
                chunk, state = np.array(lacking).T
                for j, s, x, n in zip(*map(np.ndarray.tolist, (chunk, state, *self.read(kinds, starts[chunk], ends[chunk], state)))):
                    maps[j][s] = (x, n)
            left = later
