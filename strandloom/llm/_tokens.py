"""Token ids of whole texts in an executor's Python worker, a batch at a time."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

#: Texts of these characters only: each stays as it is under NFC, is lower-cased alone, and of them
#: just the six ASCII ones are white space. Then a word between them has the same ids in any text.
PLAIN = "\\t-\\r\\x20-\\x7e\\x{a1}-\\x{12f}\\x{131}-\\x{17f}"
#: Bytes of words and ids that a worker process keeps at most; beyond it, those that were met once are let go.
KEPT_BYTES = 16 << 20
#: Bytes of text that are worked on at once, about; a longer text is worked on alone.
AT_ONCE = 4 << 20
#: Units that the library gets at once, and marks at the end of a word that may be cut off.
TOGETHER, MARKS = 2000, 8
#: By byte: the ASCII marks but the apostrophe, which can be part of a piece with letters; ASCII letters and digits.
IS_MARK = np.array([33 <= i < 127 and not chr(i).isalnum() and i != 39 for i in range(256)])
IS_WORD = np.array([i < 128 and chr(i).isalnum() for i in range(256)])


def gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` at places ``at``, one after another, and the length of each."""
    own = counts[at]
    ends = np.cumsum(own, dtype=np.int64)
    place = np.repeat((starts[at] - (ends - own)).astype(np.int32), own)
    place += np.arange(len(place), dtype=np.int32)
    return ids[place], own


def by_list(lists: pa.ListArray, counts: np.ndarray) -> np.ndarray:
    """The sum of ``counts``, one for each value, in each list."""
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return np.diff(ends[offsets - offsets[0]])


def in_two(words: pa.Array) -> pa.Array:
    """Each word as two strings over the same bytes: the marks at its end are the second, if a letter or digit is before them.

    Then the marks are a piece by themselves. Up to MARKS ASCII marks count; the second string is often empty.
    """
    _, places, data = words.buffers()
    n = len(words)
    ends = np.frombuffer(places, np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.concatenate([np.zeros(2, np.uint8), np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)])
    start, cut = ends[:-1], ends[1:].copy()
    live = np.arange(n)
    for _ in range(MARKS):
        live = live[(cut[live] > start[live])]
        live = live[IS_MARK[data[cut[live] + 1]]]
        if not len(live):
            break
        cut[live] -= 1
    last, before = data[cut + 1], data[cut]
    sound = (cut > start) & (IS_WORD[last] | (before == 0xC4) | (before == 0xC5) | ((before == 0xC3) & (last != 0x97) & (last != 0xB7)))
    both = np.empty(2 * n + 1, np.int32)
    both[::2], both[1::2] = ends, np.where(sound, cut, ends[1:])
    return pa.StringArray.from_buffers(2 * n, pa.py_buffer(both), words.buffers()[2])


class WordEncoder:
    """Ids by a file of the tokenizers library.

    A file that lower-cases and cuts a text at white space gives a word the same ids wherever
    it stands. So each distinct word of a batch is looked at once, and the ids of words without the marks at their end are
    made once by the library's own model and kept in flat arrays. Texts with characters for which a word's ids could depend
    on where it stands, and other kinds of file, go through the library as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = self._pattern(spec)
        self.marks = [t["content"].lower() for t in spec.get("added_tokens") or []]
        # the file's model on pieces that are cut and spelled already; the printable ASCII characters stand for their own bytes
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = WhitespaceSplit()
        spelled = ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary, suffix = self.tokenizer.get_vocab(), spec["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.letters = {i: spelled.pre_tokenize_str(chr(i))[0][0] for i in range(0xA1, 0x180)}
        self._keep(pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64))

    @staticmethod
    def _pattern(spec: dict):
        norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        by_words = (
            norm == ["NFC", "Replace", "Lowercase"]
            and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
            and cut[0].get("behavior") == "Removed"
            and cut[0].get("invert") is True
            and cut[1].get("add_prefix_space") is False
            and cut[1].get("use_regex") is False
            and spec.get("post_processor") is None
            and spec["model"].get("end_of_word_suffix")
        )
        return regex.compile(cut[0]["pattern"]["Regex"]) if by_words else None

    def _keep(self, units: pa.Array, ids: np.ndarray, counts: np.ndarray, used: np.ndarray) -> None:
        """The table of known units: their ids one after another, how many each has, and in how many words each was met."""
        self.units, self.ids, self.counts, self.used = units, ids, counts, used
        self.starts = np.cumsum(counts) - counts

    def _forget(self) -> None:
        kept = np.flatnonzero(self.used > 1)
        ids, counts = gathered(self.ids, self.starts, self.counts, kept)
        self._keep(self.units.take(pa.array(kept)), ids, counts, np.ones(len(kept), np.int64))

    def _ids_of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``units`` one after another, by the library, and how many each has."""
        pieces, n_pieces = [], np.ones(len(units), np.int64)
        for i, unit in enumerate(units):
            if unit.isalpha():
                pieces.append(unit)
            else:
                own = self.pattern.findall(unit)
                n_pieces[i] = len(own)
                pieces += own
        spelled = [x if x.isascii() else x.translate(self.letters) for x in pieces]
        made = self.pieces.encode_batch_fast([" ".join(spelled)], add_special_tokens=False)[0].ids
        ids = np.array(made, np.uint32)
        # a piece ends with the first id whose token ends a word
        ends = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(self.ends_word[ids]) + 1])
        return ids, np.diff(ends[np.concatenate([np.zeros(1, np.int64), np.cumsum(n_pieces)])])

    def _learn(self, units: pa.Array) -> None:
        """Add distinct ``units`` that aren't in the table."""
        made = [self._ids_of(units.slice(at, TOGETHER).to_pylist()) for at in range(0, len(units), TOGETHER)]
        self._keep(
            pa.concat_arrays([self.units, units]), np.concatenate([self.ids, *[x for x, _ in made]]),
            np.concatenate([self.counts, *[n for _, n in made]]), np.concatenate([self.used, np.zeros(len(units), np.int64)]),
        )

    def _by_word(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct ``words`` one after another, and how many each has."""
        units = in_two(words)
        found = pc.index_in(units, value_set=self.units)
        at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if found.null_count:
            new = units.filter(found.is_null()).dictionary_encode()
            at[found.is_null().to_numpy(zero_copy_only=False)] = len(self.units) + new.indices.to_numpy()
            self._learn(new.dictionary)
        self.used += np.bincount(at, minlength=len(self.used))
        ids, counts = gathered(self.ids, self.starts, self.counts, at)
        if self.units.nbytes + self.ids.nbytes + 24 * len(self.counts) > KEPT_BYTES:
            self._forget()
        return ids, counts[::2] + counts[1::2]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` one after another (nulls are empty), and where each text's end: offsets from 0 on."""
        texts = pc.fill_null(texts, "")
        if self.pattern is None:
            odd = np.ones(len(texts), bool)
        else:
            low = pc.utf8_lower(texts)
            strange = pc.match_substring_regex(texts, f"[^{PLAIN}]")
            for mark in self.marks:
                strange = pc.or_(strange, pc.match_substring(low, mark))
            odd = strange.to_numpy(zero_copy_only=False)
        ids, offsets = np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if not odd.all():
            lists = pc.ascii_split_whitespace(pc.if_else(strange, "", low) if odd.any() else low)
            words = lists.flatten().dictionary_encode()
            ids, counts = self._by_word(words.dictionary)
            ids, counts = gathered(ids, np.cumsum(counts) - counts, counts, words.indices.to_numpy())
            offsets = np.concatenate([offsets[:1], np.cumsum(by_list(lists, counts))])
        if odd.any():
            parts, start, more = [], 0, np.zeros(len(texts) + 1, np.int64)
            for i in np.flatnonzero(odd).tolist():
                own = self.whole(texts[i].as_py())
                parts += [ids[start : offsets[i]], own]
                start = offsets[i]
                more[i + 1] = len(own)
            ids, offsets = np.concatenate([*parts, ids[start:]]), offsets + np.cumsum(more)
        return ids, offsets


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and each thread more memory
    return WordEncoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets as of ``encode``, with ``end_id`` after each text."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))
