"""Token counts by a tokenizer compiled to a finite-state transducer.

The transducer reads the bytes of a pre-token. Its transitions say how many tokens have become certain,
and each state how many more there are if the pre-token ends there. States are made when a
text first needs them, so only what occurs is compiled, and a machine that has grown too large is begun anew.

A text is cut into chunks of equal length, which advance side by side. What a chunk does to the state it is
entered in is its state map: behind the first pre-token that begins in the chunk the map is constant. So
all chunks run up to their ends at once, without knowing their entries; then the maps are composed by a
prefix scan, which hands every chunk its entry for the bytes before that point.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.llm.workers import give_back

CHUNK = 64  # bytes per chunk
SLICE = 1 << 19  # characters counted at once; a longer text is cut at white space
MOST_STATES = 1 << 18  # a machine with more is begun anew; some 300 bytes each
BYTES = 256
NONE = -1  # no token: at the beginning of a pre-token, or where no token can begin
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd: the golden ratio in 64 bits
VOID, ROOT = 0, 1  # the state of a chunk whose entry is not known yet, and that of an empty pre-token
LAST = "</w>"
SPACE, LETTER, NUMBER, OTHER, UNSEEN = 0, 1, 2, 3, 255

# Fixed value: the split pattern of the kind of tokenizer that is compiled here. CONTRACTIONS are its endings.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, back to its byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merge rules, and which two tokens may stand beside each other.

    Tokens are numbers: a byte, a byte that ends a pre-token, and what each merge makes, in the order of the merges. A
    sequence of tokens is what a text encodes to exactly if no two neighbours would have merged
    across their seam on the way; so every beginning of a text encodes to what a shorter one does, and one
    more token.
    """

    def __init__(self, pairs: list[tuple[str, str]]) -> None:
        byte = _byte_letters()
        self.inner = {bytes([b]): b for b in range(256)}  # tokens within a pre-token,
        self.final = {bytes([b]): BYTES + b for b in range(256)}  # and those that end one
        self.parts: list[tuple[int, int]] = [(-1, -1)] * 2 * BYTES
        self.whole: dict[tuple[int, int], int] = {}

        def token(text: str) -> tuple[bytes, dict[bytes, int]]:
            last = text.endswith(LAST)
            text = text[: -len(LAST)] if last else text
            return bytes(map(byte.__getitem__, text)), self.final if last else self.inner

        for a, b in pairs:
            left, among = token(a)
            right, kind = token(b)
            if among is self.final or left not in among or right not in kind or left + right in kind:
                raise ValueError(f"the merge of {a!r} and {b!r} does not follow from those before it")
            kind[left + right] = self.whole[among[left], kind[right]] = len(self.parts)
            self.parts.append((among[left], kind[right]))
        known = {t for kind in (self.inner, self.final) for t in kind}
        self.beginnings = {t[:n] for t in known for n in range(len(t) + 1)}
        self.seams: dict[tuple[int, int], bool] = {}

    def neighbours(self, a: int, b: int) -> bool:
        """Do both tokens stay as they are where ``b`` follows ``a``?"""
        known = self.seams.get((a, b))
        if known is None:
            known = self.seams[a, b] = self._neighbours(a, b)
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        """Merges are undone from the last to the first. Two parts that meet at the seam would have merged if
        their own merge came before the one that took one of them; of equal ones the left one comes first."""
        until = never = len(self.parts)
        while self.whole.get((a, b), never) >= until:
            if b >= a and b >= 2 * BYTES:
                until, b = b + 1, self.parts[b][0]
            elif a >= 2 * BYTES:
                until, a = a, self.parts[a][1]
            else:
                return True
        return False


class Transitions:
    """A growing hash table from (state, byte) to the next state and the tokens that become certain."""

    def __init__(self) -> None:
        self.used = 0
        self._allot(12)

    def _allot(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.key = np.full(1 << bits, -1, np.int64)
        self.next = np.zeros(1 << bits, np.int32)
        self.sure = np.zeros(1 << bits, np.int16)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, and the places of those that the table lacks."""
        slot = self._slot(keys)
        held = self.key[slot]
        away = np.flatnonzero(held != keys)
        missing = [away[:0]]
        while len(away):
            none = held[away] < 0
            missing.append(away[none])
            away = away[~none]
            slot[away] = (slot[away] + 1) & (len(self.key) - 1)
            held[away] = self.key[slot[away]]
            away = away[held[away] != keys[away]]
        return slot, np.concatenate(missing)

    def put(self, key: int, target: int, sure: int) -> None:
        if 2 * self.used >= len(self.key):
            kept = self.key >= 0
            old = self.key[kept].tolist(), self.next[kept].tolist(), self.sure[kept].tolist()
            self._allot(len(self.key).bit_length())
            self.used = 0
            for row in zip(*old):
                self.put(*row)
        at = int(self._slot(np.array([key]))[0])
        while self.key[at] >= 0:
            at = (at + 1) & (len(self.key) - 1)
        self.key[at], self.next[at], self.sure[at] = key, target, sure
        self.used += 1


class Machine:
    """The transducer of pre-tokens, as far as it has been compiled.

    What a state stands for: the bytes read that can still be part of a token; before each of them and at the
    end, if a token may begin there, the last token and the number of tokens, less that before the first of them.
    """

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.begin_anew()

    def begin_anew(self) -> None:
        self.table = Transitions()
        self.rest = np.zeros(1024, np.int16)  # further tokens if the pre-token ends in a state
        self.numbers: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.merges.seams.clear()
        self._state(b"", [NONE], [-1], 0)  # VOID, never left
        self._state(b"", [NONE], [0], 0)

    def _state(self, read: bytes, lasts: list[int], counts: list[int], rest: int) -> int:
        n = len(lasts)
        packed = struct.pack(f"<{n}i{n}hh", *lasts, *counts, rest) + read
        number = self.numbers.setdefault(packed, len(self.states))
        if number == len(self.states):
            self.states.append(packed)
            if number == len(self.rest):
                self.rest = np.concatenate([self.rest, np.zeros_like(self.rest)])
            self.rest[number] = rest
        return number

    def _compile(self, state: int, byte: int) -> None:
        packed = self.states[state]
        n = (len(packed) - 1) // 7  # 4 n + 2 n + 2 bytes, and n - 1 that were read
        lasts = struct.unpack_from(f"<{n}i", packed)
        counts = struct.unpack_from(f"<{n}h", packed, 4 * n)
        read = packed[6 * n + 2 :] + bytes([byte])
        merges = self.merges
        token = final = NONE
        for start, last in enumerate(lasts):
            piece = read[start:]
            for kind in (merges.inner, merges.final):
                at = kind.get(piece)
                if at is not None and (last == NONE or merges.neighbours(last, at)):
                    if kind is merges.inner:
                        token, count = at, counts[start] + 1
                    else:
                        final, ended = at, counts[start] + 1
        assert token != NONE and final != NONE
        lasts, counts = (*lasts, token), (*counts, count)
        drop = 0
        while read[drop:] not in merges.beginnings:
            drop += 1
        read, sure = read[drop:], counts[drop]
        used = [read[i:] in merges.beginnings for i in range(len(read) + 1)]
        lasts = [t if u else NONE for t, u in zip(lasts[drop:], used)]
        counts = [c - sure if u else 0 for c, u in zip(counts[drop:], used)]
        self.table.put(state << 8 | byte, self._state(read, lasts, counts, ended - sure), sure)

    def step(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and the tokens that the transitions make certain."""
        keys = states.astype(np.int64) << 8 | data
        slots, missing = self.table.find(keys)
        if len(missing):
            for key in np.unique(keys[missing]).tolist():
                if key >> 8 == VOID:
                    self.table.put(key, VOID, 0)
                else:
                    self._compile(key >> 8, key & 255)
            slots, _ = self.table.find(keys)
        return self.table.next[slots], self.table.sure[slots]

    def run(self, states: np.ndarray, starts: np.ndarray, lengths: np.ndarray, data, begins) -> tuple[np.ndarray, np.ndarray]:
        """Every chunk's state at its end and its tokens, all chunks a byte at a time. ``begins`` marks
        the first bytes of pre-tokens; where one begins, the one before has ended."""
        states, tokens = states.copy(), np.zeros(len(states), np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        now, total = states[order], tokens[order]
        for j in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(-lengths, -j, "left"))  # chunks that have a byte j
            at = starts[:n] + j
            if begins is not None:
                first = np.flatnonzero(begins[at])
                total[first] += self.rest[now[first]]
                now[first] = ROOT
            now[:n], sure = self.step(now[:n], data[at])
            total[:n] += sure
        states[order], tokens[order] = now, total
        return states, tokens

    def count(self, data: np.ndarray, begins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; text i has the bytes from offsets[i] up to offsets[i + 1]."""
        sizes = np.diff(offsets)
        parts = -(-sizes // CHUNK)
        first_chunk = np.concatenate([[0], np.cumsum(parts)])
        text = np.repeat(np.arange(len(sizes)), parts)
        starts = offsets[:-1][text] + CHUNK * (np.arange(len(text)) - first_chunk[text])
        lengths = np.minimum(CHUNK, offsets[1:][text] - starts)
        if not len(text):
            return np.zeros(len(sizes), np.int64)
        # state maps: constant behind the first begin, for any entry
        exits, tokens = self.run(np.full(len(text), VOID, np.int32), starts, lengths, data, begins)
        heads = self._heads(begins, starts, lengths)
        whole = heads == lengths  # chunks inside one pre-token: their maps are not constant
        # the prefix scan: an entry is the exit of the chunk before. A chunk inside a pre-token first guesses
        # that one begins there; entries change until each equals the exit before it
        entered = np.full(len(text), VOID, np.int32)
        guess = np.flatnonzero(whole)
        if len(guess):
            exits[guess], _ = self.run(np.full(len(guess), ROOT, np.int32), starts[guess], lengths[guess], data, None)
        before = np.zeros(len(text), np.int64)
        later = np.flatnonzero(text[1:] == text[:-1]) + 1  # all but the first chunk of each text
        while True:
            entry = exits[later - 1]
            changed = entry != entered[later]
            todo, entry = later[changed], entry[changed]
            if not len(todo):
                break
            entered[todo] = entry
            after, sure = self.run(entry, starts[todo], heads[todo], data, None)
            inside = whole[todo]
            before[todo] = sure + np.where(inside, 0, self.rest[after])
            exits[todo[inside]] = after[inside]
        tokens += before
        ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
        tokens[ends] += self.rest[exits[ends]]
        found = np.zeros(len(sizes), np.int64)
        np.add.at(found, text, tokens)
        return found

    @staticmethod
    def _heads(begins: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Bytes of each chunk before the first pre-token that begins in it."""
        at = np.flatnonzero(begins)
        following = np.append(at, len(begins))[np.searchsorted(at, starts)]
        return np.minimum(following - starts, lengths)


class TokenCounter:
    """Counts the tokens of whole texts as the library that reads ``definition`` does."""

    def __init__(self, definition: bytes) -> None:
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        check_definition(parts)
        library = Tokenizer.from_str(definition.decode())
        self.normalized, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.machine = Machine(Merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]))
        self.marks = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.mark = re.compile("|".join(map(re.escape, self.marks)))
        self.kinds = np.full(0x110000, UNSEEN, np.uint8)

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        """Space, letter, number or other, by the library's own tables, asked once for each character."""
        kinds = self.kinds[codes]
        if (kinds == UNSEEN).any():
            for code in np.unique(codes[kinds == UNSEEN]).tolist():
                c = chr(code)
                if self.normalized(c) == " ":
                    kind = SPACE
                elif len(self.split("a" + c)) == 1:
                    kind = LETTER
                else:
                    kind = OTHER if len(self.split("!" + c)) == 1 else NUMBER
                self.kinds[code] = kind
            kinds = self.kinds[codes]
        return kinds

    def _plain(self, text: str) -> str:
        """The text as the library normalises it, but for its runs of white space."""
        if _LATIN(text):  # composed as it is; lower-cased the same by either
            return text.lower()
        return self.normalized(text)

    def _begins(self, codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The characters that pre-tokens begin with, by the split pattern."""
        begins = kinds != SPACE
        begins[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
        quotes = np.flatnonzero(begins & (codes == ord("'")))
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        for ending in CONTRACTIONS:
            fits = np.ones(len(quotes), bool)
            for i, c in enumerate(ending, 1):
                fits &= padded[quotes + i] == ord(c)
            at = quotes[fits]
            begins[at + 1] = False
            at = at + 1 + len(ending)
            at = at[at < len(codes)]
            begins[at[kinds[at] != SPACE]] = True
        return begins

    def _count_slice(self, texts: list[str]) -> np.ndarray:
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = self._kinds(codes)
        begins = self._begins(codes, kinds)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        data = np.frombuffer(joined.encode(), np.uint8)
        kept = kinds != SPACE
        width_kept = width[kept]
        ends = np.cumsum(width_kept)
        first = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
        first[(ends - width_kept)[begins[kept]]] = True
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        held = np.concatenate([[0], np.cumsum(np.where(kept, width, 0))])
        return self.machine.count(data[np.repeat(kept, width)], first, held[bounds])

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; NULL has none."""
        found = np.zeros(len(texts), np.int64)
        rows: list[int] = []
        waiting: list[str] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if len(self.machine.states) > MOST_STATES:
                self.machine.begin_anew()
            if rows:
                np.add.at(found, rows, self._count_slice(waiting))
            rows.clear()
            waiting.clear()
            held = 0

        for row, text in enumerate(texts):
            text = text.as_py()
            if not text:
                continue
            if any(mark in text for mark in self.marks):
                text, n = self.mark.subn("\n", text)
                found[row] += n
            for piece in _pieces(text):
                piece = self._plain(piece)
                rows.append(row)
                waiting.append(piece)
                held += len(piece)
                if held >= SLICE:
                    flush()
        flush()
        return found


_LATIN = re.compile("[\x00-ɏ]*").fullmatch
_GAP = re.compile("[ \t\n\r]").search


def _pieces(text: str) -> Iterator[str]:
    """The text, cut after white space if it is long; no pre-token goes across."""
    start = 0
    while len(text) - start > SLICE:
        gap = _GAP(text, start + SLICE)
        if not gap:
            break
        yield text[start : gap.end()]
        start = gap.end()
    yield text[start:] if start else text


def check_definition(parts: dict) -> None:
    """Refuse a tokenizer that is not of the kind compiled here."""
    model = parts["model"]
    wanted = {
        "type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": LAST,
        "byte_fallback": False, "ignore_merges": False,
    }
    odd = [k for k, v in wanted.items() if model.get(k, v) not in (v, "" if v is None else v)]
    normalizers = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    split = splits[0] if splits else {}
    if (
        odd
        or normalizers != ["NFC", "Replace", "Lowercase"]
        or [s["type"] for s in splits] != ["Split", "ByteLevel"]
        or split.get("pattern") != {"Regex": PATTERN}
        or splits[1].get("use_regex", True)
        or splits[1].get("add_prefix_space", True)
        or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
        or len(model["vocab"]) < 512 + len(model["merges"])
    ):
        raise ValueError(f"not a lower-casing byte-level BPE with word ends {odd}")


_counters: dict[str, TokenCounter] = {}


def _counter(digest: str, definition: bytes) -> TokenCounter:
    if digest not in _counters:  # once per worker, which keeps its machine from task to task
        _counters.clear()
        _counters[digest] = TokenCounter(definition)
    return _counters[digest]


def count_tokens(df: DataFrame, tokenizer_path: str, text_col: str = "text", into: str = "n_tokens") -> DataFrame:
    """The frame with ``into``: the tokens of each whole text, without added begin or end tokens.

    ``tokenizer_path`` is a definition that the public tokenizer library reads, of a lower-casing
    byte-level BPE with word ends; any other kind is refused. Its special strings inside a text
    are one token each, as that library has it by default. NULL, empty and blank texts have 0 tokens;
    repeated rows are counted each; a column called ``into`` is replaced and all others, whatever
    their names, pass through. Row by row, no shuffle. A task holds the batch, the machine (at most about
    100 MB) and some 100 bytes per character of a slice of 512 K characters; a text longer than that is cut
    at white space, and only a longer run without any is held as a whole.
    """
    with open(tokenizer_path, "rb") as file:
        definition = file.read()  # a megabyte or two; goes to the executors with the function
    check_definition(json.loads(definition))
    digest = hashlib.sha256(definition).hexdigest()

    @F.arrow_udf("long")
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        counter = _counter(digest, definition)
        for texts in columns:
            yield pa.array(counter.count(texts), pa.int64())

    return df.withColumn(into, count(F.col(text_col)))
