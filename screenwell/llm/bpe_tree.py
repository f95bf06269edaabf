"""BPE encoding and decoding by tree concatenation."""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import worker_state

VOCABULARY = "word_bpe_49k.json"
GAPS = re.compile("[ \t\n\r\x0b\x0c]")
#: Of texts without other characters, lower case and pieces are the same in every Unicode version.
PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the UTF-8 bytes of characters 0 to 255: printable bytes as
    themselves, the others in order as characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class Encoder:
    """Encodes whole texts exactly as the tokenizers library does with one vocabulary file.

    White space never enters a token of this vocabulary, so a text is the concatenation of its
    pieces, and a piece that was seen before is looked up (at most ``kept`` are held, then the table
    starts anew). A piece over ``leaf`` characters is cut into halves down to leaves; two encoded
    halves are joined by ``join``. Texts with characters beyond Latin-1 letters or with special
    strings are split by the library itself, one white-space-free run at a time.
    """

    def __init__(self, path: str, leaf: int = 2048, kept: int = 100_000):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.leaf, self.kept = spec["model"], leaf, kept
        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.end = model["end_of_word_suffix"]
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.last = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.end)
        self.letters = byte_letters()
        self.known: dict[str, tuple[bytes, str]] = {}
        self.runs: dict[str, tuple[bytes, str]] = {}

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and what the library's decode makes of them."""
        if "<|" in text or not PLAIN.fullmatch(text):
            return self.encode_runs(text)
        known, found = self.known, []
        for piece in PIECES.findall(text.lower()):
            entry = known.get(piece)
            if entry is None:
                if len(known) >= self.kept:
                    known.clear()
                mapped = piece.translate(self.letters)
                if len(mapped) <= self.leaf:
                    tokens = self.last.tokenize(mapped)
                    entry = (struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]),
                             " ".join([t.value for t in tokens]))
                else:
                    entry = self.pack([i for i, _ in self.tree(mapped, True)])
                known[piece] = entry
            found.append(entry)
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def pack(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), self.whole.decode(ids, skip_special_tokens=False)

    def encode_runs(self, text: str) -> tuple[bytes, str]:
        runs, found = self.runs, []
        for run in GAPS.sub(" ", text).split(" "):
            entry = runs.get(run)
            if entry is None:
                if len(runs) >= self.kept // 4:
                    runs.clear()
                entry = self.pack(self.whole.encode(run, add_special_tokens=False).ids
                                  if len(run) <= self.leaf else self.run(run))
                runs[run] = entry
            if entry[0]:
                found.append(entry)
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    # a long run

    def run(self, text: str) -> list[int]:
        """Ids of one long run: special strings first, then the pieces that are encoded apart."""
        out = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
            if part in self.special:
                out.append(self.whole.token_to_id(part))
            elif part:
                for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(
                        self.whole.normalizer.normalize_str(part)):
                    out += [i for i, _ in self.tree(piece, True)]
        return out

    def tokens(self, text: str, last: bool) -> list[tuple[int, str]]:
        found = (self.last if last else self.inner).tokenize(text)
        strip = len(self.end)
        return [(t.id, t.value[:-strip] if last and t.value.endswith(self.end) else t.value)
                for t in found]

    def tree(self, text: str, last: bool) -> list[tuple[int, str]]:
        """Tokens of ``text``; ``last``: it ends a word. Halves are encoded apart and joined."""
        if len(text) <= self.leaf:
            return self.tokens(text, last)
        middle = len(text) // 2
        return self.join(self.tree(text[:middle], False), self.tree(text[middle:], last), last)

    def join(self, left: list, right: list, last: bool) -> list:
        """Re-encode a growing window round the join until both of its edges agree.

        A token sequence is the encoding of its text if and only if each two neighbours are the
        encoding of theirs, and inside the halves and the window they are. So the whole is right as
        soon as the pairs across both edges of the window are; a window that covers all is.
        """
        width = 4
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            at_end = j == len(right)
            window = self.tokens("".join(t for _, t in left[i:] + right[:j]), last and at_end)
            fits = i == 0 or self.agree(left[i - 1], window[0], last and at_end and len(window) == 1)
            if fits and (at_end or self.agree(window[-1], right[j], last and j + 1 == len(right))):
                return left[:i] + window + right[j:]
            width *= 2

    def agree(self, a: tuple[int, str], b: tuple[int, str], last: bool) -> bool:
        return [i for i, _ in self.tokens(a[1] + b[1], last)] == [a[0], b[0]]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None) -> Encoder:
    state = worker_state()
    key = f"encoder:{path}"
    if key not in state:
        state[key] = Encoder(path or vocabulary_path())
    return state[key]


def digest(doc_id, ids: bytes, text: str) -> tuple:
    return (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def halves(text: str, size: int) -> list[str]:
    """Leaves of the tree of halves of ``text``, each of at most ``size`` characters."""
    if len(text) <= size:
        return [text]
    return halves(text[: len(text) // 2], size) + halves(text[len(text) // 2:], size)


def encode_leaf(enc: Encoder, text: str) -> tuple[str, bool, bytes, str, str]:
    """A leaf as (open head, closed, ids, decoded, open tail): its first and last runs may go on in
    the neighbours and stay text; ``closed`` is false when it has no white space at all."""
    first, last = GAPS.search(text), len(GAPS.split(text)[-1])
    if not first:
        return text, False, b"", "", ""
    ids, decoded = enc.encode(text[first.start(): len(text) - last])
    return text[: first.start()], True, ids, decoded, text[len(text) - last:]


def join_leaves(enc: Encoder, leaves: list[tuple]) -> tuple[bytes, str]:
    """Concatenate encoded leaves; the runs across each join are re-encoded as one."""
    ids, texts = [], []

    def close(run: str) -> None:
        if run:
            own, text = enc.encode(run)
            ids.append(own)
            texts.append(text)

    held: list[str] = []
    for head, closed, own, text, tail in leaves:
        held.append(head)
        if closed:
            close("".join(held))
            ids.append(own)
            texts.append(text)
            held = [tail]
    close("".join(held))
    return b"".join(ids), " ".join(t for t in texts if t)


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str | None = None, leaf_chars: int = 65_536,
                     text: str = "text", key: str = "doc_id",
                     finish: Callable = digest, schema: str = RESULT) -> DataFrame:
    """Encode each whole text and decode it again; one row per row of ``docs``.

    Texts of up to ``leaf_chars`` characters are encoded where they are read. Longer ones are cut
    into halves down to leaves that are dealt out to all tasks, and joined per text: white-space
    runs across a join are encoded anew, and a run without white space grows over as many leaves as
    it has. ``finish(key, ids, decoded)`` makes the output row; ids are little-endian 32-bit.

    Null and empty texts give no tokens; repeated rows and keys stay rows of their own; columns
    beyond key and text are not read, whatever their names.
    """
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            yield pd.DataFrame([finish(k, *enc.encode(t)) for k, t in
                                zip(batch["k"], batch["t"], strict=True)], columns=names)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, row, value in zip(batch["k"], batch["row"], batch["t"], strict=True):
                leaves = halves(value, leaf_chars)
                yield pd.DataFrame({"k": k, "row": row, "place": range(len(leaves)), "t": leaves})

    def leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            done = pd.DataFrame([encode_leaf(enc, t) for t in batch["t"]],
                                columns=["head", "closed", "ids", "decoded", "tail"])
            yield pd.concat([batch[["k", "row", "place"]], done], axis=1)

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        leaves = group[["head", "closed", "ids", "decoded", "tail"]].itertuples(index=False, name=None)
        return pd.DataFrame([finish(group["k"].iloc[0], *join_leaves(encoder(path), list(leaves)))],
                            columns=names)

    kind = docs.schema[key].dataType.simpleString()
    whole = rows.where(F.length("t") <= leaf_chars).mapInPandas(short, schema)
    long = (rows.where(F.length("t") > leaf_chars)
            .withColumn("row", F.monotonically_increasing_id())
            .mapInPandas(cut, f"k {kind}, row long, place long, t string")
            .repartition("row", "place")
            .mapInPandas(leaf, f"k {kind}, row long, place long, head string, closed boolean, "
                               "ids binary, decoded string, tail string")
            .groupBy("row").applyInPandas(joined, schema))
    return whole.unionByName(long)
