"""Token ids by the tokenizers library, with ids of text pieces kept between texts.

A byte-level BPE of the GPT-2 family cuts a text where letters, digits and other marks meet and before a white space that
anything else follows, and never joins ids across such a place. Texts are cut at those of these places that their bytes show
beyond doubt, the pieces are told apart by Arrow's dictionary encoding, those that were not met before are encoded by the
library in one batch, and the ids of a text are those of its pieces. Letters after a space go straight to the library's BPE
model, as there is nothing to cut in them. Added tokens of the tokenizer's file, such as <|endoftext|>, are found in a text
before all else, as the library does, and each is a piece. The result equals that of encoding each text alone with the
tokenizer as its file has it, without special tokens put around the text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CAPACITY = 500_000
#: Classes of bytes. OTHER: what is not sure (control characters, white space beyond ASCII, most characters of several bytes).
OTHER, LETTER, DIGIT, MARK, SPACE, FEED, HIGH, QUOTE = range(8)
#: First bytes of two-byte characters that are letters, but for U+00D7 and U+00F7.
LETTER_LEADS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1)
#: First bytes of the characters that may be white space.
BLANK_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
#: What holds between two neighbouring bytes: a cut between them, a cut before the first.
BETWEEN, BEFORE = 1, 2


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    for b in range(33, 127):
        table[b] = DIGIT if chr(b).isdigit() else LETTER if chr(b).isalpha() else MARK
    table[[ord(" "), ord("\n"), ord("'")]] = SPACE, FEED, QUOTE
    table[0xC4:0xF5] = HIGH
    table[list(BLANK_LEADS)] = OTHER
    table[list(LETTER_LEADS)] = LETTER
    return table


def _meetings() -> np.ndarray:
    """By 8 times the class of a byte plus that of the next. A quote may open a contraction, so nothing is cut after it."""
    table = np.zeros((8, 8), np.uint8)
    for a, others in ((LETTER, (DIGIT, MARK, QUOTE)), (DIGIT, (LETTER, MARK, QUOTE)), (MARK, (LETTER, DIGIT))):
        table[a, others] = BETWEEN
    shown = (LETTER, DIGIT, MARK, QUOTE, HIGH)
    table[SPACE, shown] = BEFORE
    table[FEED, shown] = BEFORE | BETWEEN
    return table.reshape(-1)


CLASSES, MEETINGS = _classes(), _meetings()


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces start in the bytes of texts that lie one after another; bounds: start of each text and the last's end."""
    kind = CLASSES[data]
    leads = np.flatnonzero((kind == LETTER) & (data >= 0x80))
    leads = leads[leads < len(data) - 1]
    kind[leads + 1] = LETTER
    signs = leads[(data[leads] == 0xC3) & ((data[leads + 1] == 0x97) | (data[leads + 1] == 0xB7))]
    kind[signs], kind[signs + 1] = HIGH, OTHER
    meeting = MEETINGS[kind[:-1] * np.uint8(8) + kind[1:]]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    meeting[inner - 1] = 0
    cut = np.zeros(len(data), bool)
    cut[1:] = meeting & BETWEEN
    cut[:-1] |= (meeting & BEFORE) > 0
    cut[inner] = True
    cut[:1] = True
    return np.flatnonzero(cut)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, null as empty, and where each text starts, with the last's end."""
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    return np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str, capacity: int = CAPACITY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = list(self.library.get_added_tokens_decoder().values())
        if self.library.normalizer or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("a tokenizer that changes texts, or has added tokens that take or ask for what is beside them")
        found = sorted((t.content.encode() for t in added), key=len, reverse=True)  # the longest at a place wins
        self.added = re.compile(b"|".join(map(re.escape, found))) if found else None
        self.words = Tokenizer(self.library.model)
        self.vocabulary = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.vocabulary <= 1 << 16 else np.dtype("<u4")
        self.characters = byte_characters()
        self.opens = np.array([(self.library.id_to_token(k) or "").startswith(self.characters[32]) for k in range(self.vocabulary)])
        self.capacity = capacity
        self.kept = pa.array([], pa.binary())
        self.ids = np.zeros(0, self.dtype)  # of all kept pieces, one after another
        self.ends = np.zeros(1, np.int64)  # 0, then the end of each piece there

    def _library(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for k in range(0, len(texts), 4096) for e in self.library.encode_batch_fast([t.decode() for t in texts[k : k + 4096]], add_special_tokens=False)]
        return np.array([k for ids in found for k in ids], self.dtype), np.fromiter(map(len, found), np.int64, len(found))

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of pieces that are a space and letters, which the model takes as they are."""
        plain = [w.decode("latin-1").translate(self.characters) for w in words]
        found = self.words.encode_batch_fast([plain[k : k + 500] for k in range(0, len(plain), 500)], is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in found])
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(words):
            return self._library(words)
        return ids, np.diff(starts, append=len(ids))

    def _new(self, pieces: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """The pieces in another order, that order, their ids one after another and the number of ids of each."""
        word = np.fromiter((p[:1] == b" " and p[1:].isalpha() for p in pieces), bool, len(pieces))
        order = np.concatenate((np.flatnonzero(word), np.flatnonzero(~word)))
        moved, n = [pieces[k] for k in order.tolist()], int(word.sum())
        done = [f(own) for f, own in ((self._words, moved[:n]), (self._library, moved[n:])) if own]
        return moved, order, *map(np.concatenate, zip(*done))

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column, null as empty."""
        ids, bounds = self._flat(texts)
        return [ids[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_column(pa.array(texts, pa.string()))

    def _added(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Start and end of each added token in the texts, ascending."""
        found = []
        if self.added and self.added.search(data):
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                found += [m.span() for m in self.added.finditer(data, a, b)]
        return np.array(found, np.int64).reshape(-1, 2)

    def _flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where those of each text start, with the last's end."""
        data, bounds = text_bytes(texts)
        if not len(data):
            return np.zeros(0, self.dtype), bounds
        spans = self._added(data, bounds)
        starts = piece_starts(data, np.unique(np.concatenate((bounds, spans.ravel()))))
        if len(spans):
            at = np.searchsorted(spans[:, 0], starts) - 1  # the last that begins before
            starts = starts[(at < 0) | (starts >= spans[at, 1])]
        places = np.append(starts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        pieces, code = coded.dictionary, coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(pieces, value_set=self.kept), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        unknown = np.flatnonzero(at < 0)
        known, all_ids, all_ends = len(self.kept), self.ids, self.ends
        if len(unknown):
            fresh, order, ids, sizes = self._new(pieces.take(pa.array(unknown)).to_pylist())
            at[unknown[order]] = np.arange(known, known + len(fresh))
            all_ids = np.concatenate((self.ids, ids))
            all_ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
            if known + len(fresh) <= self.capacity:  # else these pieces serve this batch only
                self.kept = pa.concat_arrays([self.kept, pa.array(fresh, pa.binary())])
                self.ids, self.ends = all_ids, all_ends
        first, size = all_ends[at][code], (all_ends[at + 1] - all_ends[at])[code]
        ends = np.concatenate(([0], np.cumsum(size)))
        found = all_ids[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        return found, ends[np.searchsorted(starts, bounds)]


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
