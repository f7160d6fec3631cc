"""Token ids of whole texts, with the pieces of text that recur encoded once per task."""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from tenura.llm.arrow import raw  # noqa: E402

KEPT_WORDS = 750_000
#: Kept ids are bounded too: texts that cannot be cut are long words.
IDS_A_WORD = 8
SLICE_BYTES = 8 << 20
# The white space of Unicode, and four controls that Python counts with it.
VISIBLE = r"[^\t-\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WIDE_BLANKS = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE = [int.from_bytes(c.encode(), "big") for c in WIDE_BLANKS]
BETWEEN, BARE = rf"\A {VISIBLE}+\z", rf"\A{VISIBLE}+\z"
#: First bytes of two-byte characters that are all letters, but for the two signs of arithmetic below.
LEADS = [0xC3, 0xC4, 0xC5, 0xC6, 0xD0, 0xD1]
SIGNS = [int.from_bytes(c.encode(), "big") for c in "\xd7\xf7"]


def read_spec(path: str) -> str:
    """The tokenizer file as text, for sending to tasks that may not see the path."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def splits_at_spaces(spec: dict) -> bool:
    """Whether text may be cut before a space that follows a visible character, without changing ids.

    So it is if a byte-level pre-tokenizer with its own pattern is all that precedes the merges: its
    pattern lets a space begin a token and otherwise only joins white space with white space. Added
    tokens must hold no white space and not swallow any beside them. The pattern also never joins a letter
    or digit with punctuation behind it, nor a single line break with what is visible after it.
    """
    before = spec.get("pre_tokenizer") or {}
    plain = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"])
        for t in spec.get("added_tokens", ())
    )
    return (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space", True) and plain
    )


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _numbers(places: dict[str, int], words: list[str]) -> np.ndarray:
    return np.fromiter(map(places.__getitem__, words), np.int64, len(words))


def borders(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where pieces begin of the texts that lie end to end in ``data``.

    Texts are cut only where that surely keeps their ids (see `splits_at_spaces`); rarer such places are left out.

    ``marks`` tells for each byte whether it is punctuation before which words may end. Bytes before a text's
    first belong to another text; what they allow is a cut at the text's beginning, which is one anyway.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True

    def before(places: np.ndarray, back: int) -> np.ndarray:
        return data[np.maximum(places - back, 0)].astype(np.int32)

    spaces = np.flatnonzero(data == 0x20)
    last = before(spaces, 1)
    visible = (last > 0x20) & (last < 0x7F)
    wide = np.flatnonzero(last >= 0x80)
    two = before(spaces[wide], 2) << 8 | last[wide]
    visible[wide] = ~(np.isin(two, WIDE) | np.isin(before(spaces[wide], 3) << 16 | two, WIDE))
    cut[spaces[visible]] = True

    signs = np.flatnonzero(marks[data])
    last = before(signs, 1)
    word = ALNUM[last]
    wide = np.flatnonzero(last >= 0x80)
    lead = before(signs[wide], 2)
    word[wide] = LETTER_LEADS[lead] & ~np.isin(lead << 8 | last[wide], SIGNS)
    cut[signs[word]] = True

    lines = np.flatnonzero(data[:-1] == 0x0A)
    last, next_ = before(lines, 1), data[lines + 1]
    alone = (last > 0x20) & (last < 0x7F) & ((next_ > 0x20) & (next_ < 0x7F) | LETTER_LEADS[next_])
    cut[lines[alone] + 1] = True
    return np.flatnonzero(cut[:-1])


def _table(numbers) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(numbers)] = True
    return table


ALNUM = _table(c for c in range(128) if chr(c).isalnum())
LETTER_LEADS = _table(LEADS)


class Encoder:
    """Ids of many texts by the tokenizers library.

    For byte-level vocabularies texts are cut into words, punctuation and line breaks (see `splits_at_spaces`),
    and a piece's ids are kept, up to a bounded number of pieces; with all others texts go to the library
    whole. Strings of special tokens become these tokens, as is the library's default, unless
    ``plain_specials`` is set.
    """

    def __init__(self, spec: str, kept_words: int = KEPT_WORDS, plain_specials: bool = False):
        self.limit = kept_words
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = plain_specials
        self.library.no_truncation()
        self.library.no_padding()
        parsed = json.loads(spec)
        self.by_words = splits_at_spaces(parsed)
        within = {c for t in parsed.get("added_tokens", ()) for c in t["content"]}
        self.marks = _table(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in within)
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.opens = np.zeros(self.size, bool)
        for token, number in vocabulary.items():
            self.opens[number] = token.startswith("Ġ")
        self.line = vocabulary.get("Ċ", -1)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}  # in the order of entries
        self.begins, self.counts = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.again = np.zeros(1024, bool)
        self.store, self.used = np.zeros(1 << 16, np.uint32), 0
        self.entries = 0

    def _forget(self, words: list[str]) -> None:
        """Start anew, but with the pieces met again since the last time; of too many, with those of the given words."""
        again = self.again[: self.entries]
        if 2 * again.sum() > self.limit or 2 * self.counts[: self.entries][again].sum() > IDS_A_WORD * self.limit:
            kept = [w for w in words if w in self.known]
        else:
            kept = [*compress(self.known, again.tolist())]
        entries = _numbers(self.known, kept)
        flat, counts = self._gather(entries), self.counts[entries]
        self._clear()
        self._remember(kept, flat, counts)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, flat: np.ndarray, counts: np.ndarray) -> int:
        """Store runs of ids; returns the entry of the first."""
        first, need = self.entries, self.entries + len(counts)
        if need > len(self.counts):
            room = max(need, 2 * len(self.counts))
            self.begins, self.counts, self.again = (
                np.concatenate([x, np.zeros(room - len(x), x.dtype)]) for x in (self.begins, self.counts, self.again)
            )
        if self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(len(flat), len(self.store)), np.uint32)])
        self.store[self.used : self.used + len(flat)] = flat
        self.counts[first:need] = counts
        self.begins[first:need] = self.used + np.cumsum(counts) - counts
        self.used += len(flat)
        self.entries = need
        return first

    def _learn(self, each: pa.Array) -> np.ndarray:
        """Encode new pieces of text; returns their entries.

        Words are encoded many in one text: those with a space before them begin where a token begins with a
        space, others are parted by line breaks, which stay tokens of their own.
        """
        pieces, entries = each.to_numpy(zero_copy_only=False), np.full(len(each), -1)
        for kind, between in ((BETWEEN, ""), (BARE, "\n")):
            places = np.flatnonzero(pc.match_substring_regex(each, kind).to_numpy(zero_copy_only=False))
            for at in range(0, len(places), 10_000):
                part = pieces[places[at : at + 10_000]].tolist()
                flat = np.array(self.whole([between + between.join(part)])[0], np.uint32)
                opens = flat == self.line if between else self.opens[flat]
                edges = np.flatnonzero(opens)
                if len(edges) == len(part) and not edges[0]:
                    counts = np.diff(np.append(edges, len(flat))) - len(between)
                    first = self._remember(part, flat[~opens] if between else flat, counts)
                    entries[places[at : at + 10_000]] = np.arange(first, first + len(part))
        other = np.flatnonzero(entries < 0)
        if len(other):
            part = pieces[other].tolist()
            ids = self.whole(part)
            first = self._remember(part, np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids]))
            entries[other] = np.arange(first, first + len(part))
        return entries

    def _remember(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> int:
        first = self._keep(flat, counts)
        self.known.update(zip(words, range(first, first + len(words))))
        return first

    def _gather(self, entries: np.ndarray) -> np.ndarray:
        counts = self.counts[entries]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[entries] - (ends - counts), counts)
        return self.store[places]

    def encode(self, column: pa.Array, want_ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Flat ids of all texts (null: empty), or None if not wanted, and the number of ids of each."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.by_words:
            ids = self.whole(texts.to_pylist())
            return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)
        data, offsets = raw(texts)
        starts = borders(data, offsets, self.marks)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, ends, pa.py_buffer(data)]).dictionary_encode()
        words = _strings(coded.dictionary)
        if self.entries > self.limit or self.used > IDS_A_WORD * self.limit:
            self._forget(words)
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(missing):
            found[missing] = self._learn(coded.dictionary.take(pa.array(missing)))
        entries = found[coded.indices.to_numpy()]
        sums = np.concatenate([[0], np.cumsum(self.counts[entries])])
        return self._gather(entries) if want_ids else None, np.diff(sums[np.searchsorted(starts, offsets)])


@lru_cache(maxsize=1)
def encoder(spec: str, kept_words: int = KEPT_WORDS, plain_specials: bool = False) -> Encoder:
    """One encoder per process and file, so that later tasks find the words of earlier ones.

    With ``plain_specials`` the strings of special tokens are ordinary text.
    """
    return Encoder(spec, kept_words, plain_specials)
