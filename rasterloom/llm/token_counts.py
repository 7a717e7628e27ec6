"""Token counts of whole texts by a byte-level BPE vocabulary, with a whole-token shortcut.

Before the job, the driver proves which strings of the vocabulary encode alone as exactly one token: the string must
be valid UTF-8, be one pre-token, and come back from the merges as its own id. A pre-token in that set costs one token
without any merge; every other distinct pre-token is merged once by the library and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: The split pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points that the pattern above and the library's own splitting put into different classes, as they
#: know different versions of Unicode (tests/llm/test_small_cases.py compares all others one by one); a text with any of
#: these goes to the library as a whole.
STRANGE = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f-\u209f\ua7ce-\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010eee"
    "\U00011b0a\U00011db0-\U00011df1\U0001246f-\U00012686\U00016ea0-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U000191d2"
    "\U0001b123-\U0001b168\U0001d6a6\U0001df1f-\U0001dfff\U0001e6c0-\U0001e6ff\U0002b73a-\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
#: Distinct pre-tokens that a worker remembers before it starts anew.
CACHE = 400_000


def byte_alphabet() -> dict[int, str]:
    """Byte value to the printable character that stands for it in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """The strings that are proven to be one token when they stand alone."""
    back = {c: b for b, c in byte_alphabet().items()}
    one = regex.compile(PATTERN)
    found = []
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if (m := one.match(text)) and m.end() == len(text):
            found.append((text, number))
    coded = tokenizer.encode_batch([t for t, _ in found], add_special_tokens=False)
    return [t for (t, number), e in zip(found, coded) if e.ids == [number]]


class _Costs(dict):
    """Tokens by pre-token; a missing one is merged and kept."""

    def __init__(self, tokenizer: Tokenizer, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merge, self.letters = whole, tokenizer.model.tokenize, byte_alphabet()

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(piece.encode().decode("latin-1").translate(self.letters)))
        if len(self) >= CACHE + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self[piece] = n
        return n


class Counter:
    """Counts tokens as the library does by default: without begin or end, added tokens in a text recognised."""

    def __init__(self, spec: str, whole: list[str]):
        self.tokenizer = Tokenizer.from_str(spec)
        self.costs = _Costs(self.tokenizer, whole)
        self.pieces = regex.compile(PATTERN)
        self.strange = regex.compile(f"[{STRANGE}]")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def count(self, text: str) -> int:
        if self.strange.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts, n = [text], 0
        if self.added and self.added.search(text):
            parts = self.added.split(text)
            n = len(parts) - 1
        cost = self.costs
        for part in parts:
            if len(part) < 1_000_000:
                n += sum([cost[x] for x in self.pieces.findall(part)])
            else:
                n += sum(cost[m.group()] for m in self.pieces.finditer(part))
        return n


def _plain(spec) -> bool:
    """Whether the shortcut's premises hold for a tokenizer file; if not, every text goes to the library."""
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
        and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )


def with_token_counts(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit) for the whole of each text.

    A null text counts as empty: 0 bytes, 0 tokens, false. Columns of those names are replaced, all others stay;
    rows are neither merged nor dropped, and an empty table gives an empty one. The tokenizer file (its size is that of a vocabulary) is read once by the
    driver and broadcast with the proven set.
    """
    import json

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    tokenizer = Tokenizer.from_str(spec)
    plain = _plain(json.loads(spec))
    sent = df.sparkSession.sparkContext.broadcast((spec, whole_tokens(tokenizer) if plain else None))

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spec, whole = sent.value
        if whole is None:
            library = Tokenizer.from_str(spec)
            count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
        else:
            count = Counter(spec, whole).count
        for texts in batches:
            yield pa.array([count(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return (
        df.withColumn("n_tokens", n_tokens(F.col(text)))
        .withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
