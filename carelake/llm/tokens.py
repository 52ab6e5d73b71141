"""Token ids of whole texts, by the tokenizers library, through a cache of words.

A tokenizer that splits at white space gives a text the ids of its words, one after the other.
Most words of a corpus are repeats, so each Python worker keeps the ids of the words it has met.
Texts are parted into words, equal words found, and ids put together for many texts at a time, in
arrays; only distinct words are looked at one by one. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``; ``tests/llm`` holds the two against each other.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LONGEST_CACHED = 48
_CHUNK = 500
_TEXT_BYTES = 4 << 20
_MARKS = frozenset(".,;:!?")
# A mark behind a letter and before white space. The letters are those that neither the normal form
# nor small writing turns into more than one character.
_MARK_BEHIND = (
    r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([.,;:!?])([\x20\x09-\x0D]|$)"
)
_encoders: dict[tuple, "WordEncoder"] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's own encoder for a tokenizer file; its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    """``max_words`` bounds the cache. It has two halves: when the younger one is full it becomes
    the older one, and what the older one then had and nobody asked for again is forgotten."""

    def __init__(self, path: str, max_words: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.half = max(max_words // 2, 1)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(size, dtype=bool)
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.splits_at_space = bool(suffix)
        self.letters_only = _for_letters(spec)
        self.plain = self.letters_only or self.tokenizer
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """Per text its ids and then ``end_id``, as little-endian integers of ``self.dtype``.
        None is the empty text."""
        found = []
        for _, ids, ends in self.parts(pa.array(texts, pa.string()), end_id):
            found += [part.tobytes() for part in np.split(ids, ends[:-1])]
        return found

    def parts(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The ids of few texts at a time, however long they are, one text after another and each
        with ``end_id`` behind: the first text of the part, ids, and where each text's ids end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        start = 0
        while start < len(texts):
            within = np.searchsorted(np.cumsum(sizes[start : start + (1 << 16)], dtype=np.int64), _TEXT_BYTES)
            stop = min(start + max(int(within), 1), len(texts))
            ids, many = self._part(texts.slice(start, stop - start))
            ends = np.cumsum(many + 1)
            out = np.full(len(ids) + len(many), end_id, dtype=self.dtype)
            own = np.ones(len(out), dtype=bool)
            own[ends - 1] = False
            out[own] = ids
            yield start, out, ends
            start = stop

    def _part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and how many each has."""
        if not self.splits_at_space:
            found = self._encode(texts.to_pylist())
            return self._joined(found), np.array([len(f) for f in found], dtype=np.int64) // self.dtype.itemsize
        words = pc.ascii_split_whitespace(self._with_fewer_words(texts))
        coded = words.flatten().dictionary_encode()
        found = self._known(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        firsts, each = np.cumsum(lengths) - lengths, coded.indices.to_numpy()
        many = lengths[each]
        ends = np.cumsum(many)
        ids = self._joined(found)[np.repeat(firsts[each] - (ends - many), many) + np.arange(many.sum())]
        of_text = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(words).to_numpy())]
        return ids, np.diff(of_text, prepend=0)

    def _with_fewer_words(self, texts: pa.Array) -> pa.Array:
        """Texts of the same ids that have fewer distinct words, where the tokenizer is known to write
        small letters and to part marks from letters. Tokens that it knows as such keep theirs."""
        if not self.letters_only:
            return texts
        if not any(pc.any(pc.match_substring(texts, t, ignore_case=True)).as_py() for t in self.added):
            texts = pc.ascii_lower(texts)
        return pc.replace_substring_regex(texts, _MARK_BEHIND, r"\1 \2\3")

    def _joined(self, found: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(found), self.dtype)

    def _known(self, words: list[str]) -> list[bytes]:
        if len(self.young) + len(words) > self.half:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i in new:
            found[i] = self.old.get(words[i])
        missing = [i for i in new if found[i] is None]
        for i, ids in zip(missing, self._learned([words[i] for i in missing]), strict=True):
            found[i] = ids
        self.young.update((words[i], found[i]) for i in new if len(words[i]) <= _LONGEST_CACHED)
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _learned(self, words: list[str]) -> list[bytes]:
        """The ids of words that are in no cache. A mark behind letters is a piece of its own. Words
        of letters go many at a time: joined by spaces, they are cut apart again at the tokens that
        end a piece. If those are not one per word, and for all other words, each goes by itself."""
        out: dict[str, bytes] = {}
        marked, letters, alone = {}, [], []
        for word in words:
            stem = word[:-1] if word[-1:] in _MARKS else word
            if not (stem.isascii() and stem.isalpha()) and not (
                stem.lower().isalpha() and unicodedata.is_normalized("NFC", stem)
            ):
                alone.append(word)
                continue
            if stem != word:
                marked[word] = stem
            letters.append(stem)
        letters = list(dict.fromkeys(letters))
        for at in range(0, len(letters), _CHUNK):
            chunk = letters[at : at + _CHUNK]
            ids = np.array(self.plain.encode_batch_fast([" ".join(chunk)], add_special_tokens=False)[0].ids, self.dtype)
            stops = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(stops) != len(chunk):
                alone += chunk
                continue
            raw = ids.tobytes()
            out.update((word, raw[a:b]) for word, a, b in zip(chunk, [0, *stops], stops, strict=False))
        alone += {word[-1] for word in marked}
        out.update(zip(alone, self._encode(alone), strict=True))
        out.update((word, out[stem] + out[word[-1]]) for word, stem in marked.items())
        return [out[word] for word in words]


def _for_letters(spec: dict):
    """The tokenizer without the search for pieces and for white space, which words of letters in
    one normal form do not need: each is a piece. None if it is not known to be of this kind."""
    from tokenizers import Tokenizer

    normalizer, before = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = normalizer.get("normalizers", [])
    parts = before.get("pretokenizers", [])
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if steps != [{"type": "NFC"}, spaces, {"type": "Lowercase"}] or len(parts) != 2:
        return None
    split, of_bytes = parts
    if split.get("type") != "Split" or "|[\\p{L}]+|" not in split.get("pattern", {}).get("Regex", "") or not split.get("invert"):
        return None
    if of_bytes.get("type") != "ByteLevel" or of_bytes.get("use_regex") or of_bytes.get("add_prefix_space"):
        return None
    plain = {**normalizer, "normalizers": [steps[0], steps[2]]}
    at_space = {**before, "pretokenizers": [{"type": "WhitespaceSplit"}, of_bytes]}
    return Tokenizer.from_str(json.dumps({**spec, "normalizer": plain, "pre_tokenizer": at_space}))
