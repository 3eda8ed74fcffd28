"""Ids of whole texts by the files of public tokenizers.

A byte-level merge vocabulary (``.json``) is run by ``tiktoken`` where its ids are the order of its merges, which
gives the ids of ``tokenizers`` in a sixth of the time (tested over whole tables), and by ``tokenizers`` else; a
piece model (``.model``) by ``sentencepiece``. Strings that name a special token are ordinary text.

Neither kind joins characters across a lone space between two others, so longer texts than ``SLICE`` characters
are taken in slices that end before such a space: the libraries' memory follows the longest word, not the text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np
from pyspark import SparkFiles

BORDER = re.compile(r"(?<=\S) (?=\S)")
SLICE = 1 << 20
#: How byte-level vocabularies cut a text before they merge. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PublicIds:
    """A tokenizer file; ``bytes_of`` has the bytes that each id stands for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallel work
        #: Whether the library puts a space before a text by itself.
        self.adds_space = not path.endswith(".json")
        #: Whether ids always stand for the text's own bytes, as plain byte-level merges do.
        self.lossless = False
        if self.adds_space:
            import sentencepiece

            own = sentencepiece.SentencePieceProcessor(model_file=path)
            self.run = own.encode
            self.bytes_of = [bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace("▁", " ").encode() for i in range(own.get_piece_size())]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            self.bytes_of = _byte_level(own)
            merger = _merger(own, self.bytes_of)
            self.run, self.lossless = merger or (lambda text: own.encode(text, add_special_tokens=False).ids), merger is not None

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as uint32."""
        ids, at = array("I"), 0
        while len(text) - at > SLICE:
            border = BORDER.search(text, at + SLICE)
            if border is None:
                break
            ids.extend(self.run(text[at : border.start()]))
            at = border.end() if self.adds_space else border.start()
        ids.extend(self.run(text[at:] if at else text))
        return np.frombuffer(ids, np.uint32) if ids else np.empty(0, np.uint32)


def _byte_level(own) -> list[bytes]:
    """The bytes of each entry. Byte-level vocabularies spell a byte as a printable character: itself, or, for the
    68 bytes that are none, the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    special = {t.content for t in own.get_added_tokens_decoder().values()}
    return [s.encode() if (s := own.id_to_token(i)) in special else bytes(map(byte.__getitem__, s)) for i in range(own.get_vocab_size())]


def _merger(own, bytes_of: list[bytes]):
    """The same merges run by ``tiktoken``, or None where the file is no plain byte-level vocabulary in merge order."""
    import tiktoken

    spec = json.loads(own.to_str())
    special = {t["id"] for t in spec["added_tokens"]}
    vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ordered = [vocab["".join(m)] for m in merges] == list(range(256, 256 + len(merges)))
    cut = spec["pre_tokenizer"] or {}
    if not ordered or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    ranks = {b: i for i, b in enumerate(bytes_of) if i not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def load(name: str) -> PublicIds:
    """The tokenizer shipped with the job under ``name``; a worker process reads it once for all its tasks."""
    held = sys.__dict__.setdefault("_strandweave_public_ids", {})
    path = SparkFiles.get(name)
    if path not in held:
        held[path] = PublicIds(path)
    return held[path]
