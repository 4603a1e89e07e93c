"""Public tokenizers inside tasks. The model file is read once on the driver and travels as a broadcast
of checked size, so executors need no copy at the same path."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_MODEL_BYTES = 64 << 20
MAX_REMEMBERED = 400_000


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The model file at a local ``path`` of the driver (.json or .model)."""
    with open(path, "rb") as file:
        content = file.read(MAX_MODEL_BYTES + 1)
    if len(content) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast((path.endswith(".json"), content))


def splits_at_spaces(content: bytes) -> bool:
    """Whether a .json tokenizer surely gives a text the tokens of its space-separated words in turn:
    its rules drop all white space and no rule looks across it."""
    model = json.loads(content)
    normalizers = _steps(model.get("normalizer"), "normalizers")
    pre = _steps(model.get("pre_tokenizer"), "pretokenizers")
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(n["type"] not in ("NFC", "NFD", "Lowercase") and n != spaces for n in normalizers) or not pre:
        return False
    first, *rest = pre
    pattern = first.get("pattern", {}).get("Regex", " ").replace("[^\\s\\p{L}\\p{N}]+", "")
    dropped = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
    plain = not any(x in pattern for x in (" ", "\\s", ".", "\\W", "[^", "\\P"))
    return dropped and plain and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] for x in rest)


def _steps(part: dict | None, name: str) -> list[dict]:
    return [] if part is None else part[name] if part["type"] == "Sequence" else [part]


class Encoder:
    """Ids of texts as the model's library gives them, without special tokens added."""

    def __init__(self, model: Broadcast):
        self.is_json, content = model.value
        if self.is_json:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core is all it may use
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_str(content.decode())
            self.model.no_truncation()
            self.model.no_padding()
            self.by_word = splits_at_spaces(content)
        else:
            from sentencepiece import SentencePieceProcessor

            self.model = SentencePieceProcessor(model_proto=content)
            self.by_word = False
        self.sizes: dict[bytes, int] = {}

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        if self.is_json:
            return [e.ids for e in self.model.encode_batch_fast(list(texts), add_special_tokens=False)]
        return self.model.encode(list(texts), num_threads=1)

    def count(self, text: bytes) -> int:
        """Number of tokens. Words of models that split at spaces are encoded once and remembered."""
        if not self.by_word:
            return len(self.ids([text.decode()])[0])
        words = text.split()
        new = list({w for w in words if w not in self.sizes})
        if new:
            if len(self.sizes) + len(new) > MAX_REMEMBERED:
                self.sizes.clear()
                new = list(set(words))
            self.sizes.update(zip(new, map(len, self.ids([w.decode() for w in new]))))
        return sum(map(self.sizes.__getitem__, words))


def pieces(model: Broadcast) -> list[str]:
    """The piece of each id, in the order of ids; ids that are not in use are empty."""
    coder = Encoder(model)
    if coder.is_json:
        by_id = {i: piece for piece, i in coder.model.get_vocab(with_added_tokens=True).items()}
        return [by_id.get(i, "") for i in range(max(by_id) + 1)]
    return [coder.model.id_to_piece(i) for i in range(coder.model.get_piece_size())]
