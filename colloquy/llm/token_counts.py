"""Token counts of whole texts, as the tokenizer's own library gives them.

The texts of an Arrow batch are encoded in calls of about equal bytes, and only
the lengths leave the task. Texts are cut where no token can reach across, long
ones for any vocabulary that has such places, so that a call is bounded; the
counts of the pieces are added. Where tokens never reach from a word to the white
space after it, every text is cut there, and a piece that the task has met is not
encoded again. The vocabulary goes to the tasks as the bytes of its file, which
are a parameter and the same at any size of the table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CALL_BYTES = 256 << 10  # of text that one call of the library encodes
LONG_BYTES = 64 << 10  # longer texts are cut
SPACE = re.compile(r"[A-Za-z0-9.,;:!?][ \n\t]")  # before the white space; no token has white space after another character
EDGE = re.compile(r"[A-Za-z][0-9.,;:!?(){}\[\]/+*=_-]|[0-9][A-Za-z]|[一-鿿][。，；！？]")
OTHER = "\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"  # white space that libraries may see otherwise
WORDS = re.compile(rf"\s*\S+(?:[{OTHER}]\s*\S*)*|\s+")  # a word with the white space before it
KNOWN_PIECES = 300_000  # that a worker keeps the lengths of, twice
KNOWN_CHARS = 48  # of a piece that is kept
TEXT_AT_ONCE = 1 << 20  # characters of texts whose words are listed together
SINGLE = re.compile(r"[a-z] [a-z]")  # one space between words, which the next piece's own mark stands for

_loaded: dict[str, "Counter"] = {}  # in a Python worker, by digest of the file


class Counter:
    """The library for one vocabulary, and where its texts may be cut."""

    def __init__(self, model: bytes, kind: str):
        self.special: list[str] = []
        self.known: dict[str, int] = {}  # lengths of pieces met lately
        self.before: dict[str, int] = {}  # of those met before them
        if kind == "json":
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(model.decode())
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.lengths = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            form = json.loads(model)
            added = form.get("added_tokens") or []
            self.special = [t["content"] for t in added]
            before = form.get("pre_tokenizer") or {}
            plain = form.get("normalizer") is None and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
            words = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            self.borders = (SPACE, EDGE) if plain and words else ()
            self.by_words = plain and words
            self.skipped = 0
        elif kind == "model":
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.lengths = lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
            pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
            joining = any(re.search("[^▁]▁", p) for p in pieces)
            marked = processor.encode("a b") == processor.encode("a") + processor.encode("b")
            self.borders = (SINGLE,) if marked and not joining else ()
            self.by_words = False
            self.skipped = 1
        else:
            raise ValueError(f"no library for a .{kind} file")

    def cut(self, text: str, least: int) -> list[str]:
        """The text in pieces of ``least`` characters or a little more, cut at borders only."""
        pieces, at = [], 0
        while self.borders and len(text) - at > least:
            end = self.border(text, at + least)
            if end is None:
                break
            pieces.append(text[at:end])
            at = end + self.skipped
        pieces.append(text[at:])
        return pieces

    def border(self, text: str, start: int) -> int | None:
        """The first place from ``start`` on where tokens end, outside special tokens."""
        for border in self.borders:
            for found in border.finditer(text, start, min(len(text), start + LONG_BYTES)):
                if not self.within_special(text, found.start() + 1):
                    return found.start() + 1
        for border in self.borders[:1]:
            for found in border.finditer(text, start):
                if not self.within_special(text, found.start() + 1):
                    return found.start() + 1
        return None

    def within_special(self, text: str, at: int) -> bool:
        return any(text.find(s, max(0, at - len(s) + 1), at + len(s) - 1) >= 0 for s in self.special)


def loaded(model: bytes, kind: str) -> Counter:
    digest = hashlib.sha256(model).hexdigest() + kind
    if digest not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _loaded.clear()
        _loaded[digest] = Counter(model, kind)
    return _loaded[digest]


def calls(pieces: Iterable[str]) -> Iterator[list[str]]:
    """The pieces in calls of about ``CALL_BYTES`` bytes."""
    held: list[str] = []
    size = 0
    for piece in pieces:
        more = len(piece) if piece.isascii() else len(piece.encode())
        if held and size + more > CALL_BYTES:
            yield held
            held, size = [], 0
        held.append(piece)
        size += more
    if held:
        yield held


def in_order(counter: Counter, texts: Iterable[str]) -> Iterator[int]:
    """The number of tokens of each text, with every piece encoded."""
    owners: list[int] = []

    def pieces() -> Iterator[str]:
        for n, text in enumerate(texts):
            for piece in counter.cut(text, LONG_BYTES) if len(text) > LONG_BYTES else (text,):
                owners.append(n)
                yield piece

    done = at = total = 0  # texts passed on, pieces counted, tokens of the text at hand
    for call in calls(pieces()):
        for length in counter.lengths(call):
            while done < owners[at]:
                yield total
                done, total = done + 1, 0
            total += length
            at += 1
    if owners:
        yield total


def by_words(counter: Counter, texts: Iterable[str]) -> Iterator[int]:
    """The same, with equal pieces encoded once while they are known."""

    def together(parts: list[tuple[int, str]]) -> Iterator[tuple[int, int]]:
        listed = [(n, WORDS.findall(part)) for n, part in parts]
        here = set().union(*(words for _, words in listed))
        new = here - counter.known.keys()
        if len(counter.known) + len(new) > KNOWN_PIECES:
            counter.before, counter.known = counter.known, {}
            new = here
        back = new & counter.before.keys()
        counter.known.update((w, counter.before[w]) for w in back)
        order = list(new - back)
        counter.known.update(zip(order, in_order(counter, order)))
        for n, words in listed:
            yield n, sum(map(counter.known.__getitem__, words))
        for long in [w for w in order if len(w) > KNOWN_CHARS]:
            del counter.known[long]

    def grouped() -> Iterator[list[tuple[int, str]]]:
        held, size = [], 0
        for n, text in enumerate(texts):
            for part in counter.cut(text, TEXT_AT_ONCE) if len(text) > TEXT_AT_ONCE else (text,):
                held.append((n, part))
                size += len(part)
                if size >= TEXT_AT_ONCE:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    done, total = -1, 0
    for parts in grouped():
        for n, length in together(parts):
            if n != done:
                if done >= 0:
                    yield total
                done, total = n, 0
            total += length
    if done >= 0:
        yield total


def counter(path: str) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens, by the vocabulary file at ``path``.

    A ``.json`` file is read by tokenizers, a ``.model`` file by sentencepiece,
    with their defaults for special strings inside a text; nothing is added at
    either end, cut off or padded. A null text counts as empty and has no tokens;
    repeated rows, null keys and other columns are untouched. A text above
    ``LONG_BYTES`` without a place to cut, or of a vocabulary whose tokens may
    reach across any place, is encoded in one call. The driver reads the file;
    the tasks need the library alone.
    """
    with open(path, "rb") as file:
        model = file.read()
    kind = path.rsplit(".", 1)[-1]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = loaded(model, kind)
        for batch in batches:
            counted = by_words if library.by_words else in_order
            yield pa.array(counted(library, (t.as_py() or "" for t in batch)), pa.int64())

    return F.arrow_udf(run, "long")
