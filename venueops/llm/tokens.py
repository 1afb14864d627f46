"""Token ids of whole texts, by a byte-level BPE vocabulary in the tokenizers library's JSON form."""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from venueops.llm import kernel as K

SEPARATOR = 0


def byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes that byte-level vocabularies are written in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class Vocabulary:
    """Ids as by the tokenizers library without added specials: strings of added tokens inside a text are those tokens.

    Texts without such strings are encoded by merge ranks alone, the others by the library itself.
    """

    def __init__(self, content: str):
        import tiktoken

        letters = byte_letters()
        found = json.loads(content)
        added = {x["content"]: x["id"] for x in found.get("added_tokens", [])}
        ranks = {
            bytes(letters[c] for c in token): i for token, i in found["model"]["vocab"].items() if token not in added
        }
        self.size = max(*found["model"]["vocab"].values(), *added.values()) + 1
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.content, self.library = content, None
        self.tool = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        """The text's ids and the separator."""
        if self.added is not None and self.added.search(text):
            if self.library is None:
                self.library = Tokenizer.from_str(self.content)
            found = self.library.encode(text, add_special_tokens=False).ids
        else:
            found = self.tool.encode_ordinary(text)
        return np.array([*found, SEPARATOR], dtype="<u4")


def shipped(spark: SparkSession, path: str | None):
    """A function for tasks that returns the vocabulary, read by the driver and kept by each Python worker."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    name = f"vocabulary{zlib.crc32(content.encode())}"
    sent = spark.sparkContext.broadcast(content)
    return lambda: K.per_process(name, lambda: Vocabulary(sent.value))
