"""Token counts of whole texts and of their prefixes.

White space never takes part in a token of this tokenizer family, so a text
falls into segments (runs without ASCII white space) that are encoded on their
own. The count of a prefix is then a running sum: ``tokens(first i segments) =
tokens(first i-1 segments) + tokens(segment i)``. These sums are stored with
the byte offsets where segments end. A prefix that ends inside a segment adds
the count of that segment's own prefix (:meth:`Segments.prefixes`); the table
has an entry for each character that is no white space, so truncation and budget
questions are lookups without the tokenizer.

Inside a segment the counts are a running sum over blocks, which begin where a
pre-token begins in every prefix. In a pre-token the last token of each prefix
is found among the vocabulary's entries that end there: the one that stands
unmerged beside the last token of the prefix before it. Words in alphabetical
order share what they begin with.

Segments repeat a lot; each worker keeps the ids of the segments it has met,
the common ones for as long as they keep coming. Texts of one batch are encoded
together (:meth:`Segments.encode_many`), and so are their prefix tables made
(:meth:`Segments.tables`): each different segment of them once.
"""

from __future__ import annotations

import codecs
import json
import re
import string
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import OWN, n_bytes, require, worker_cache

#: Entries that a worker keeps (a matter of memory only).
KEPT_SEGMENTS = 600_000
#: Longer segments are encoded each time they are met.
KEPT_BYTES = 64
_TAIL = string.punctuation
#: Bytes of texts that are encoded together (a longer text is encoded alone),
#: and words that go to the model in one call.
SLICE_BYTES, CALL_WORDS = 8 << 20, 1 << 14
#: Bytes of texts whose prefix tables are made together (a longer text's alone).
TABLE_BYTES = 2 << 20
#: Letters that the normalizer only lower-cases, each on its own.
_LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.lower().isalpha())


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others are numbered upward from U+0100."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Segments:
    """Ids of texts, by way of the ids of their segments."""

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # The model alone, for many words at once; the mark at a word's last token parts them.
        self.words = Tokenizer(self.model)
        self.words.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        mark = self.model.end_of_word_suffix
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if mark and all(c + mark in vocabulary for c in self.letters.values()):
            self.closes[[i for t, i in vocabulary.items() if t.endswith(mark)]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Taking texts apart at white space is right if no added token holds or
        # swallows any, and if white space is dropped between tokens.
        spaces = any(len(s.split()) != 1 or s.split()[0] != s for s in self.special)
        probe = self._encode("a \t\nb") == self._encode("a") + self._encode("b")
        if spaces or not probe or self._encode("A.") != self._encode("a") + self._encode("."):
            raise ValueError(f"{tokenizer_file}: not a tokenizer that drops white space and case")
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.counts: dict[str, list[int]] = {}
        self.joined: dict[tuple[str, str], bool] = {}
        # words that encode_many has met, their ids, and the slice that had each last
        self.met, self.met_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.met_last, self.slices = np.zeros(0, dtype=np.int64), 0
        # words that prefixes_many has met, and the tokens of their prefixes
        self.known, self.known_counts = pa.array([], pa.string()), np.zeros(0, dtype=np.int32)
        self.known_at = np.zeros(1, dtype=np.int64)
        self.table = "".join(" " if b == 32 else self.letters[b] for b in range(256))
        self.plain = None

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _letters(self, core: str) -> str | None:
        """The model's input for one pre-token that the normalizer only lower-cases, or nothing."""
        low = core.lower()
        if not (core.isalpha() and low.isalpha()):
            return None
        if core.isascii():
            return low
        if max(core) < "ɐ" and unicodedata.is_normalized("NFC", core):
            return "".join(map(self.letters.__getitem__, low.encode()))
        return None

    def _pack(self, ids: Iterable[int]) -> bytes:
        return np.fromiter(ids, dtype="<u4").tobytes()

    def _run(self, words: str, n: int) -> tuple[bytes, np.ndarray]:
        """Ids of ``n`` words in the model's letters, and the offsets where those of each end."""
        ids = np.array(self.words.encode_batch_fast([words], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = 4 * np.flatnonzero(self.closes[ids]) + 4
        if len(ends) != n:  # no such marks
            made = [self._pack(t.id for t in self.model.tokenize(w)) for w in words.split(" ")]
            return b"".join(made), np.cumsum([len(m) for m in made])
        return ids.tobytes(), ends

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words in the model's letters."""
        data, ends = self._run(" ".join(words), len(words))
        ends = ends.tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _make(self, segments: list[bytes]) -> list[bytes]:
        """Ids of segments, those of one pre-token and its punctuation together."""
        words, places, out = [], [], []
        for i, segment in enumerate(segments):
            whole = segment.decode()
            core = whole.rstrip(_TAIL)
            word = None if "<" in whole else self._letters(core)  # may hold an added token
            if word is None:
                out.append(self._pack(self._encode(whole)))
                continue
            words.append(word)
            places.append(i)
            # letters never share a pre-token with the end, which is encoded apart
            tail = whole[len(core) :]
            end = self.tails.get(tail) if tail else b""
            if end is None:
                end = self._pack(self._encode(tail))
                if len(tail) <= KEPT_BYTES and len(self.tails) < KEPT_SEGMENTS:
                    self.tails[tail] = end
            out.append(end)
        if words:
            for i, ids in zip(places, self._of_words(words)):
                out[i] = ids + out[i]
        return out

    def split(self, text: bytes) -> list[bytes]:
        # Added tokens are matched before lower-casing, so their texts keep their case.
        return (text if b"<" in text else text.lower()).split()

    def pieces(self, segments: list[bytes]) -> list[bytes]:
        """Ids of each segment, as little-endian unsigned 32-bit integers."""
        known = self.ids
        if len(known) > KEPT_SEGMENTS // 2:
            # those that are met again are taken over from the older half
            self.older, known = known, {}
            self.ids = known
        unknown = set(segments).difference(known)
        if unknown:
            made = {s: self.older[s] for s in unknown if s in self.older}
            fresh = list(unknown.difference(made))
            made.update(zip(fresh, self._make(fresh)))
            known.update(made)
        out = list(map(known.__getitem__, segments))
        for s in unknown:
            if len(s) > KEPT_BYTES:
                del known[s]
        return out

    def encode(self, text: bytes) -> bytes:
        return b"".join(self.pieces(self.split(text)))

    def encode_many(self, texts: pa.Array) -> Iterator[memoryview]:
        """Ids of each text (null: empty), as :meth:`encode` gives them."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], len(texts)]):
            # a copy, as ascii_lower takes no array whose first offset is not 0
            part = pc.fill_null(texts.take(pa.array(np.arange(a, b))).cast(pa.string()), "")
            part = pc.if_else(pc.match_substring(part, "<"), part, pc.ascii_lower(part))
            runs = pc.ascii_split_whitespace(part)
            coded = runs.flatten().dictionary_encode()
            made, place = self._different(coded.dictionary)
            ids = made.take(pa.array(place[coded.indices.to_numpy()]))
            _, at, data = ids.buffers()
            ends = np.frombuffer(at, dtype=np.int64)[runs.offsets.to_numpy()].tolist()
            data = memoryview(data or b"")
            yield from (data[i:j] for i, j in zip(ends, ends[1:]))

    def _different(self, segments: pa.StringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Ids of different segments, and where in them those of each stand."""
        # Latin letters and their punctuation apart, as in _make; "<" may begin an added token
        core = pc.utf8_rtrim(segments, _TAIL.replace("<", ""))
        tail = pc.utf8_ltrim(segments, _LATIN)
        whole, head, rest = (pc.binary_length(c).to_numpy() for c in (segments, core, tail))
        even = (head > 0) & (head + rest == whole) & (head <= KEPT_BYTES)
        mask = pa.array(even)
        cores, tails = (c.filter(mask).dictionary_encode() for c in (core, tail))
        ends = self._of_others(tails.dictionary).take(tails.indices)
        nothing = pa.scalar(b"", pa.large_binary())
        joined = pc.binary_join_element_wise(self._of_met(cores.dictionary).take(cores.indices), ends, nothing)
        others = self._of_others(segments.filter(pc.invert(mask)))
        place = np.empty(len(segments), dtype=np.int64)
        place[even] = np.arange(len(joined))
        place[~even] = len(joined) + np.arange(len(others))
        return pa.concat_arrays([joined, others]), place

    def _of_others(self, segments: pa.StringArray) -> pa.LargeBinaryArray:
        return pa.array(self.pieces([s.encode() for s in segments.to_pylist()]), pa.large_binary())

    def _of_met(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of different words of Latin letters; of those met lately without the model."""
        self.slices += 1
        found = pc.index_in(words, value_set=self.met)
        new = words.filter(found.is_null())
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.met) + np.arange(len(new))
        made = [self._of_new(new.slice(i, CALL_WORDS)) for i in range(0, len(new), CALL_WORDS)]
        self.met = pa.concat_arrays([self.met, new])
        self.met_ids = pa.concat_arrays([self.met_ids, *made])
        self.met_last = np.concatenate([self.met_last, np.zeros(len(new), dtype=np.int64)])
        self.met_last[at] = self.slices
        out = self.met_ids.take(pa.array(at))
        if len(self.met) > KEPT_SEGMENTS:
            keep = np.sort(np.argsort(-self.met_last, kind="stable")[: KEPT_SEGMENTS // 2])
            self.met, self.met_ids = self.met.take(pa.array(keep)), self.met_ids.take(pa.array(keep))
            self.met_last = self.met_last[keep]
        return out

    def _of_new(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        low = " ".join(words.to_pylist()).lower().encode()
        data, ends = self._run(codecs.charmap_decode(low, "strict", self.table)[0], len(words))
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), buffers)


    def _load_plain(self) -> None:
        """The model without its mark of word ends, for what precedes a last token."""
        from tokenizers.models import BPE

        made = json.loads(self.tokenizer.to_str())["model"]
        self.mark = made["end_of_word_suffix"] or ""
        self.vocabulary = frozenset(made["vocab"])
        # the longest token that ends in three letters, inside a word and at its end
        self.reach: tuple[dict[str, int], ...] = ({}, {})
        for token in self.vocabulary:
            for last, core in enumerate((token, token.removesuffix(self.mark))):
                if not last or token.endswith(self.mark):
                    found = self.reach[last]
                    found[core[-3:]] = max(found.get(core[-3:], 2), len(core))
        self.plain = BPE(vocab=made["vocab"], merges=[tuple(m) for m in made["merges"]])

    def _stands(self, left: str, token: str, last: bool) -> bool:
        """Whether ``token`` after the token ``left`` (or at the start) is left unmerged."""
        key = (left, token + self.mark if last else token)
        found = self.joined.get(key)
        if found is None:
            if len(self.joined) > KEPT_SEGMENTS:
                self.joined.clear()
            made = (self.model if last else self.plain).tokenize(left + token)
            found = self.joined[key] = [t.value for t in made] == [v for v in key if v]
        return found

    def _word(self, word: str) -> list[int]:
        """Tokens of the prefixes of one pre-token that the normalizer leaves alone, of 1 to all its characters."""
        return self._words([word])[0]

    def _words(self, words: list[str]) -> list[list[int]]:
        """The same of several: in their order, each goes on where it parts from the one before."""
        if self.plain is None:
            self._load_plain()
        made: list[list[int]] = [[]] * len(words)
        before, tail, count, out = "", [""], [0], [0]
        for w in sorted(range(len(words)), key=words.__getitem__):
            raw = words[w].encode()
            letters = "".join(map(self.letters.__getitem__, raw))
            same = len(commonprefix((before, letters)))
            del tail[same + 1 :], count[same + 1 :], out[same + 1 :]
            for i in range(same + 1, len(letters) + 1):
                closed, near = 0, letters[max(i - 3, 0) : i]
                # a character ends where no byte follows that goes on with it
                for last in (False, True) if i == len(raw) or raw[i] & 0xC0 != 0x80 else (False,):
                    for size in range(min(i, self.reach[last].get(near, 2)), 0, -1):
                        token = letters[i - size : i]
                        known = (token + self.mark if last else token) in self.vocabulary
                        if known and self._stands(tail[i - size], token, last):
                            break
                    else:
                        raise ValueError(f"no last token at byte {i} of {words[w]!r}")
                    if last:
                        closed = count[i - size] + 1
                    else:
                        tail.append(token)
                        count.append(count[i - size] + 1)
                out.append(closed)
            made[w] = [n for n in out if n]
            before = letters
        return made

    def _block(self, block: str, even: bool) -> list[int]:
        found = self.counts.get(block)
        if found is None:
            if even and len(block) > 1:
                found = self._word(block.lower())
            else:
                found = [len(self._encode(block[: i + 1])) for i in range(len(block))]
            if len(block) <= KEPT_BYTES:
                if len(self.counts) > KEPT_SEGMENTS:
                    self.counts.clear()
                self.counts[block] = found
        return found

    def prefixes(self, segment: str) -> list[int]:
        """Tokens of the prefixes of one segment, of 1 to all its characters."""
        kinds = list(map(_kind, segment))
        closed = set()
        for s in self.special:
            name = s.decode()
            at = segment.find(name)
            while at >= 0:
                closed.update(range(at, at + len(name)))
                at = segment.find(name, at + 1)
        # A block begins between two known kinds, not inside an added token, and
        # not after an apostrophe, which may begin a contraction.
        starts = [0]
        for p in range(1, len(segment)):
            a, b = kinds[p - 1], kinds[p]
            apart = a and b and (a != b or a == "N") and not (p in closed and p - 1 in closed)
            if apart and not (segment[p - 1] == "'" and b == "L"):
                starts.append(p)
            elif a == b == "L" and _contraction_ends(segment, kinds, starts[-1], p):
                starts.append(p)
        out, before = [], 0
        for a, b in zip(starts, [*starts[1:], len(segment)]):
            even = kinds[a] in ("L", "P") and set(kinds[a:b]) == {kinds[a]} and closed.isdisjoint(range(a, b))
            counts = self._block(segment[a:b], even)
            out.extend([before + n for n in counts])
            before = out[-1]
        return out

    def prefixes_many(self, segments: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the prefixes of different segments one after another, and
        the offsets where those of each begin."""
        core = pc.utf8_rtrim(segments, _TAIL.replace("<", ""))
        tail = pc.utf8_ltrim(segments, _LATIN)
        whole, head, rest = (pc.binary_length(c).to_numpy() for c in (segments, core, tail))
        even = (head > 0) & (head + rest == whole) & (head <= KEPT_BYTES)
        mask = pa.array(even)
        cores, tails = (c.filter(mask).dictionary_encode() for c in (core, tail))
        first, n_first = _gathered(self._prefixes_met(cores.dictionary), cores.indices.to_numpy())
        then, n_then = _gathered(_lists(self.prefixes(t) if t else [] for t in tails.dictionary.to_pylist()), tails.indices.to_numpy())
        other, other_at = _lists(map(self.prefixes, segments.filter(pc.invert(mask)).to_pylist()))
        sizes = np.empty(len(segments), dtype=np.int64)
        sizes[even], sizes[~even] = n_first + n_then, np.diff(other_at)
        at = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(at[-1], dtype=np.int32)
        out[_spread(at[:-1][even], n_first)] = first
        total = first[np.cumsum(n_first) - 1] if len(first) else first
        out[_spread(at[:-1][even] + n_first, n_then)] = then + np.repeat(total, n_then)
        out[_spread(at[:-1][~even], sizes[~even])] = other
        return out, at

    def _prefixes_met(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same of different words of Latin letters; those met lately are known."""
        found = pc.index_in(words, value_set=self.known)
        new = words.filter(found.is_null())
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(new))
        texts = new.to_pylist()
        plain = [w for w in texts if len(w) > 1 and all(_kind(c) == "L" for c in w)]
        made = dict(zip(plain, self._words([w.lower() for w in plain])))
        values, ends = _lists(made[w] if w in made else self.prefixes(w) for w in texts)
        self.known = pa.concat_arrays([self.known, new])
        self.known_counts = np.concatenate([self.known_counts, values])
        self.known_at = np.concatenate([self.known_at, self.known_at[-1] + ends[1:]])
        lists = (self.known_counts, self.known_at)
        out = _gathered(lists, at)
        if len(self.known) > KEPT_SEGMENTS:  # those of this call stay
            self.known = self.known.take(pa.array(at))
            self.known_counts, self.known_at = out[0], np.concatenate([[0], np.cumsum(out[1])])
        return out[0], np.concatenate([[0], np.cumsum(out[1])])

    def tables(self, texts: pa.Array) -> Iterator[tuple[pa.ListArray, pa.ListArray]]:
        """Prefix tables, byte offsets and tokens, of some texts after another (null: empty)."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // TABLE_BYTES
        starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], len(texts)]):
            yield self._tables(pc.fill_null(texts.take(pa.array(np.arange(a, b))).cast(pa.large_string()), ""))

    def _tables(self, texts: pa.LargeStringArray) -> tuple[pa.ListArray, pa.ListArray]:
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        begin = np.cumsum(size + 1) - size - 1
        cased = pc.if_else(pc.match_substring(texts, "<"), texts, pc.ascii_lower(texts))
        joined = " ".join(cased.to_pylist()).encode()
        data = np.frombuffer(joined + b" ", dtype=np.uint8)
        ink = ~_SPACE[data]
        # a character ends where no byte follows that goes on with it
        ends = np.flatnonzero(ink[:-1] & ((data[1:] & 0xC0) != 0x80)) + 1
        opens = np.flatnonzero(ink & ~np.concatenate([[False], ink[:-1]]))
        coded = pa.array(joined.split(), pa.binary()).cast(pa.string()).dictionary_encode()
        counts, n_counts = _gathered(self.prefixes_many(coded.dictionary), coded.indices.to_numpy())
        total = counts[np.cumsum(n_counts) - 1].astype(np.int64) if len(counts) else np.zeros(0, dtype=np.int64)
        text_of = np.searchsorted(begin, opens, side="right") - 1
        base = np.concatenate([[0], np.cumsum(total)])
        base = base[:-1] - base[np.searchsorted(text_of, text_of)]
        at = np.searchsorted(ends, np.append(begin, len(data)), side="right")
        in_text = np.diff(at)
        tokens = (counts + np.repeat(base, n_counts)).astype(np.int32)
        places = (ends - np.repeat(begin, in_text)).astype(np.int32)
        offsets = pa.array(at.astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(places)), pa.ListArray.from_arrays(offsets, pa.array(tokens))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _lists(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after another, and the offsets where each begins."""
    made = list(lists)
    values = np.fromiter(chain.from_iterable(made), dtype=np.int32)
    return values, np.concatenate([[0], np.cumsum([len(m) for m in made], dtype=np.int64)]).astype(np.int64)


def _gathered(lists: tuple[np.ndarray, np.ndarray], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of such lists one after another, and their sizes."""
    values, at = lists
    sizes = np.diff(at)[index]
    return values[_spread(at[:-1][index], sizes)], sizes


@cache
def _kind(c: str) -> str:
    """L, N or P (the rest) for characters that the normalizer takes alone, else an empty string."""
    kind = unicodedata.category(c)[0]
    low = c.lower()
    if kind not in "LNPS" or len(low) != 1 or not unicodedata.is_normalized("NFC", c) or "\u1100" <= c <= "\u11ff":
        return ""
    if kind in "LN":  # the same in all versions of Unicode
        old = unicodedata.ucd_3_2_0.category(c)[0]
        return kind if old == kind == unicodedata.category(low)[0] else ""
    return "P" if low == c else ""


def _contraction_ends(segment: str, kinds: list[str], start: int, p: int) -> bool:
    """Whether the block from ``start`` is an apostrophe and letters, and what
    begins at ``p`` is past every contraction."""
    return segment[start] == "'" and p - start == 3 and segment[start:p].lower() in _LONG_CONTRACTIONS


_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


def segments_of(tokenizer_file: str) -> Segments:
    return worker_cache("segments_" + re.sub(r"\W", "_", tokenizer_file), lambda: Segments(tokenizer_file))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def segment_ends(text: bytes) -> np.ndarray:
    """Byte offsets at which the segments of a text end."""
    if not text:
        return np.empty(0, dtype="<i4")
    blank = _SPACE[np.frombuffer(text, dtype=np.uint8)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return (ends if blank[-1] else np.append(ends, len(text))).astype("<i4")


#: Entries of prefix tables in one batch, so that a batch is bounded by this and one text.
BATCH_ENTRIES = 1 << 20


def _prefix_table(segments: Segments, text: bytes, budget: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and the tokens up to there: after each character that is no
    white space, or with ``budget`` after each run of such characters, and each
    character of the run in which the budget ends."""
    ends, runs = segment_ends(text), text.split()
    if budget is None:
        inner = range(len(runs))
        after = None
    else:
        pieces = segments.pieces(segments.split(text))
        after = np.cumsum([len(p) // 4 for p in pieces], dtype=np.int64)
        at = int(np.searchsorted(after, budget, side="right"))
        inner = [at] if at < len(runs) else []
        if not inner:
            return ends.astype(np.int32), after.astype(np.int32)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    before = 0
    if after is not None:
        at = inner[0]
        parts.append((ends[:at], after[:at]))
        before = int(after[at - 1]) if at else 0
    for r in inner:
        word = runs[r].decode()
        counts = np.array(segments.prefixes(word), dtype=np.int64)
        parts.append((ends[r] - len(runs[r]) + np.cumsum([len(c.encode()) for c in word]), before + counts))
        before += int(counts[-1])
    if after is not None:
        parts.append((ends[at + 1 :], after[at + 1 :]))
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return tuple(np.concatenate(c).astype(np.int32) for c in zip(*parts))


def prefix_counts(df: DataFrame, tokenizer_file: str, text: str = "text", budget: int | None = None) -> DataFrame:
    """``df`` with ``n_tokens`` and the prefix table of each text.

    ``prefix_ends[i]`` is the byte offset after the ``i``-th character that is no
    ASCII white space and ``prefix_tokens[i]`` the exact number of tokens of the
    text up to there. With ``budget`` the table has an entry after each run of
    such characters, and all inner ones of the run in which ``budget`` ends:
    what :func:`tokens_within` needs for budgets up to this one that end at a
    run, and for this one exactly. A null or empty text has no entries and 0
    tokens. Other columns stay. Rows are independent: no shuffle, memory bounded
    by one text.
    """
    require(df, text)
    added = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("prefix_ends", T.ArrayType(T.IntegerType(), False)),
        T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), False)),
    ]
    clash = [f.name for f in added if f.name in df.columns]
    if clash:
        raise ValueError(f"columns {clash} would be overwritten; rename them first")
    schema = T.StructType([*df.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = segments_of(tokenizer_file)
        as_list = lambda parts: pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts))
        )
        for batch in batches:
            if budget is None:
                first = 0
                for ends, tokens in segments.tables(batch.column(text)):
                    rows = batch.slice(first, len(ends))
                    first += len(ends)
                    sizes = pc.list_value_length(tokens).to_numpy()
                    total = np.zeros(len(sizes), dtype=np.int64)
                    total[sizes > 0] = tokens.flatten().to_numpy()[np.cumsum(sizes)[sizes > 0] - 1]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(total), ends, tokens], names=schema.fieldNames())
                continue
            ends, tokens, size, first = [], [], 0, 0
            for i, value in enumerate(batch.column(text)):
                found = _prefix_table(segments, (value.as_py() or "").encode(), budget)
                ends.append(found[0])
                tokens.append(found[1])
                size += len(found[0])
                if size >= BATCH_ENTRIES or i == batch.num_rows - 1:
                    total = pa.array([int(t[-1]) if len(t) else 0 for t in tokens], pa.int64())
                    rows = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, total, as_list(ends), as_list(tokens)], names=schema.fieldNames()
                    )
                    ends, tokens, size, first = [], [], 0, i + 1

    return df.mapInArrow(run, schema)


def tokens_within(budget: int | Column) -> Column:
    """Of a row of :func:`prefix_counts`: the struct (n_bytes, n_tokens) of the
    longest prefix with at most ``budget`` tokens, without white space after it."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    # a longer prefix may have fewer tokens, when its last word is a token
    i = F.array_max(F.transform("prefix_tokens", lambda n, at: F.when(n <= budget, at)))
    return F.when(
        i.isNotNull(),
        F.struct(F.get("prefix_ends", i).alias("n_bytes"), F.get("prefix_tokens", i).alias("n_tokens")),
    ).otherwise(F.struct(F.lit(0).alias("n_bytes"), F.lit(0).alias("n_tokens")))


def inner_counts(segment: str, tokenizer_file: str) -> list[int]:
    """Tokens of each prefix of one segment, of 0 to all its characters."""
    return [0, *(segments_of(tokenizer_file).prefixes(segment) if segment else [])]


def count_at(text: str, ends: list[int], tokens: list[int], n_chars: int) -> int:
    """Exact tokens of ``text[:n_chars]``: a lookup in the stored prefix table
    (a whole one, made without a budget)."""
    i = int(np.searchsorted(np.asarray(ends), len(text[:n_chars].encode()), side="right"))
    return tokens[i - 1] if i else 0


def count_tokens(df: DataFrame, tokenizer_file: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """``df`` with n_bytes, n_tokens and over_limit, read off the prefix table:
    its last entry, and whether the longest prefix within the limit is not the
    whole text.

    A null or empty text, or one of white space, has 0 tokens. Columns with one
    of these names are replaced, others stay. Memory is bounded by one text.
    """
    added = ("n_bytes", "n_tokens", "over_limit", "prefix_ends", "prefix_tokens")
    df = df.withColumnsRenamed({c: OWN + c for c in added if c in df.columns})
    name = OWN + text if OWN + text in df.columns else text
    require(df, name)
    last = F.coalesce(F.try_element_at("prefix_ends", F.lit(-1)), F.lit(0))
    return (
        prefix_counts(df, tokenizer_file, name)
        .withColumn("n_bytes", n_bytes(name))
        .withColumn("n_tokens", F.coalesce(F.try_element_at("prefix_tokens", F.lit(-1)), F.lit(0)).cast("long"))
        .withColumn("over_limit", tokens_within(limit)["n_bytes"] < last)
        .drop("prefix_ends", "prefix_tokens", *[c for c in df.columns if c.startswith(OWN)])
    )
