"""Token ids of whole texts by the ``tokenizers`` library, one piece between white space at a time.

The pre-tokenizers of the supported files never join characters across the pieces that ``find`` cuts, so a text's
ids are its pieces' ids in order. A worker keeps the ids of the pieces it has met, up to CACHE of them, and hands new
ones to the library together. A text that holds one of the file's added tokens, and any text where the file is of
another kind, is encoded by the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from functools import cache
from hashlib import sha256
from itertools import accumulate, chain, islice, pairwise
from pathlib import Path

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from biblioflow.sources.stages import stored

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Unicode white space as the library's patterns see it.
WS = r"\t-\r \x85\xa0  -     　"
LETTERS = r"[^\W\d_]+"
#: Letters that no normalizer turns into a letter and a mark.
LATIN = r"[A-Za-zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
#: Letters end a piece before ASCII punctuation that ends a run; an apostrophe may begin a contraction, so it does not.
TAIL = rf"(?=[!-&(-/:-@\[-^`{{-~]*(?:[{WS}]|$))"
CACHE = 400_000
#: New pieces handed to the library at once.
GROUP = 512


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        said = json.loads(Path(path).read_text())
        added = [t["content"] for t in said.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE).search if added else lambda text: None
        #: A mark, the same in any case, that all added tokens hold; texts without it need no search.
        self.mark = next((c for c in added[0] if c.lower() == c.upper() and all(c in t for t in added)), "") if added else ""
        names = [t for t, _ in sorted(self.library.get_vocab().items(), key=lambda x: x[1])]
        self.known: dict[str, bytes] = {}
        self.suffix = said["model"].get("end_of_word_suffix") or ""
        if (said.get("pre_tokenizer") or {}).get("type") == "ByteLevel":
            self.find = re.compile(rf" ?{LETTERS}{TAIL}|\n(?={LETTERS})|[{WS}]*[^{WS}]+|[{WS}]+").findall
            self.flag = np.array([t.startswith("Ġ") for t in names])
        elif self.suffix and not (said["pre_tokenizer"]["pretokenizers"][-1] or {}).get("use_regex", True):
            self.find = re.compile(rf"{LATIN}{TAIL}|[^{WS}]+").findall
            self.flag = np.array([t.endswith(self.suffix) for t in names])
        else:
            self.find = lambda text: [text]
            self.flag = None

    def _each(self, pieces: list[str]) -> None:
        for p, e in zip(pieces, self.library.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            self.known[p] = np.array(e.ids, dtype="<u4").tobytes()

    def _joined(self, pieces: list[str]) -> None:
        """Pieces that each are one pre-token (with a space before it, or with a word's end) share a text."""
        groups = [pieces[at : at + GROUP] for at in range(0, len(pieces), GROUP)]
        between = " " if self.suffix else ""
        for part, e in zip(groups, self.library.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            marks = np.flatnonzero(self.flag[ids])
            if len(marks) != len(part):
                self._each(part)
                continue
            bounds = np.r_[0, marks + 1] if self.suffix else np.r_[marks, len(ids)]
            data = ids.tobytes()
            for p, a, b in zip(part, (4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                self.known[p] = data[a:b]

    def _learn(self, new: list[str]) -> None:
        if self.flag is None:
            return self._each(new)
        plain = re.compile(LATIN).fullmatch if self.suffix else (lambda p: p[0] == " " and p[1:].isalpha())
        self._joined([p for p in new if plain(p)])
        self._each([p for p in new if not plain(p)])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """A null text has no ids."""
        if len(self.known) > CACHE:
            self.known = dict(islice(self.known.items(), CACHE // 2))  # what was met first is what is met often
        whole = {k for k, t in enumerate(texts) if t and self.mark in t and self.added(t)}
        rows = [self.find(t) if t and k not in whole else [] for k, t in enumerate(texts)]
        pieces = list(chain.from_iterable(rows))
        got = list(map(self.known.get, pieces))
        if new := [k for k, ids in enumerate(got) if ids is None]:
            self._learn(list({pieces[k] for k in new}))
            for k in new:
                got[k] = self.known[pieces[k]]
        if self.flag is None:
            self.known.clear()
        bounds = list(accumulate(map(len, rows), initial=0))
        out = [b"".join(got[a:b]) for a, b in pairwise(bounds)]
        for k in whole:
            out[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out


def ship(spark: SparkSession, path: str) -> str:
    """Send the tokenizer's file along with the job; the name under which ``encoder`` finds it in a task.

    The name holds the content's hash, so files of one name and other content, or a file that changes, do not meet.
    """
    data = Path(path.removeprefix("file://")).read_bytes()
    name = f"tokenizer-{sha256(data).hexdigest()}.json"
    context = spark.sparkContext
    shipped = context.__dict__.setdefault("_biblioflow_tokenizers", set())
    if name not in shipped:
        context.addFile(stored(spark, name, data))
        shipped.add(name)
    return name


@cache
def encoder(name: str) -> Encoder:
    """One encoder a worker process and shipped file."""
    return Encoder(SparkFiles.get(name))
