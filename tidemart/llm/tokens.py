"""Token ids of texts by the word tokenizer's file, one encoding per distinct chunk.

The tokenizer's pre-tokenizer never joins across blanks and line feeds, and drops them, so
a text's ids are those of its blank-separated chunks in a row. Chunks repeat a lot; each
distinct one is encoded once per worker. A chunk of Latin letters with a tail of plain
punctuation is two words to the pre-tokenizer: both go straight to the tokenizer's model,
which spares the pipeline's bookkeeping. All other chunks take the whole pipeline, so the
strings of the file's added tokens get their ids, as the library gives them by default.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from struct import pack

import numpy as np

#: Chunks, and words of them, that a worker remembers; beyond, it starts anew.
REMEMBERED = 300_000
#: Characters of a chunk that is remembered, at most.
LONGEST = 64

_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_TAIL = ".,!?%&$*#|:;"
_known: dict[str, dict[str, bytes]] = {}
_words: dict[str, dict[str, bytes]] = {}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the model's vocabulary (the public byte-level
    rule: printable bytes stand for themselves, the rest for letters from 256 on)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def encode(texts: list[str | None], path: str, end: int | None = None) -> list[np.ndarray]:
    """The ids (uint32) of each text, and ``end`` after them; null: no text."""
    known, out = _known.setdefault(path, {}), []
    tail = b"" if end is None else np.uint32(end).tobytes()
    for text in texts:
        chunks = text.replace("\n", " ").split(" ") if text else []
        ids = list(map(known.get, chunks))
        if None in ids:
            fresh = learnt({c for c, i in zip(chunks, ids) if i is None}, path)
            ids = [fresh[c] if i is None else i for c, i in zip(chunks, ids)]
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
            known.update((c, i) for c, i in fresh.items() if len(c) <= LONGEST)
        out.append(np.frombuffer(b"".join(ids) + tail, np.dtype("<u4")))
    return out


def learnt(fresh: set[str], path: str) -> dict[str, bytes]:
    """The ids of ``fresh`` chunks, as little-endian bytes."""
    whole, model, found, other = tokenizer(path), tokenizer(path).model, {}, []
    words, letters = _words.setdefault(path, {"": b""}), byte_letters()
    for c in fresh:
        word = c.rstrip(_TAIL)
        if word and not (word.isascii() and word.isalpha()) and not _LATIN.fullmatch(word):
            other.append(c)
            continue
        ids = b""
        for part in (word.lower(), c[len(word):]) if len(word) < len(c) else (word.lower(),):
            if (known := words.get(part)) is None:
                spelt = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
                ids_ = [t.id for t in model.tokenize(spelt)]
                known = pack(f"<{len(ids_)}I", *ids_)
                if len(words) >= REMEMBERED:
                    words.clear()
                    words[""] = b""
                if len(part) <= LONGEST:
                    words[part] = known
            ids += known
        found[c] = ids
    for start in range(0, len(other), 4096):
        some = other[start:start + 4096]
        for c, e in zip(some, whole.encode_batch(some, add_special_tokens=False)):
            found[c] = pack(f"<{len(e.ids)}I", *e.ids)
    return found
