"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

Texts up to ``LEAF`` characters are encoded in one go. A longer text is cut into leaves, which tasks encode in parallel;
then neighbours are concatenated pair by pair up a tree. At a join only a window around the cut is encoded again:

* The window reaches to the nearest place on both sides where the pre-tokenizer splits whatever the neighbours are: before
  white space that follows something else, or between a letter, a digit and another sign. Outside it both sides stand.
* If the text is unsplit for long (one endless word), the window is only a few tokens wide and grows until its first token
  equals the left side's token there and its last token equals the right side's. A sequence of BPE tokens in which each
  neighbouring pair is what BPE gives for the two alone is what BPE gives for the whole, so the join is then exact.

Ids equal those of the tokenizers library (add_special_tokens=False, no truncation, no padding); the string of the special
token becomes its id. The vocabulary file is a parameter and read on the driver; tiktoken, given the same vocabulary,
encodes leaves. Rules: null counts as empty and gives no tokens. Rows are independent: repeated rows, null keys and clashing names
of other columns are no special cases. Empty tables give empty results.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loreweave.llm.queries import query, table

VOCABULARY = "byte_bpe_50k.json"
# characters of a leaf that is a task's row, and of the leaves inside it if a word is longer than one of them (merging
# takes the square of a word's length); unsplit characters that are simply encoded again; tokens of the first window
LEAF = 1 << 15
FINE = 1 << 9
UNSPLIT = 1 << 8
WINDOW = 8
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
RUN_BYTES = 1 << 24  # bytes of the texts whose words are looked up together
GROUP_WORDS = 1 << 18  # words whose ids are put in place together


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings of the mergeable tokens with their ids, and special strings with theirs, from a tokenizers file."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    return {bytes(letters[c] for c in piece): i for piece, i in held["model"]["vocab"].items() if piece not in special}, special


def kind_of(c: str) -> str:
    """What a character is to the pre-tokenizer."""
    return next((k for k, p in (("space", r"\s"), ("letter", r"\p{L}"), ("digit", r"\p{N}")) if regex.match(p, c)), "sign")


class Codec:
    """Encodes and decodes in one process."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], leaf: int = LEAF, fine: int = FINE, unsplit: int = UNSPLIT, window: int = WINDOW) -> None:
        self.leaf, self.fine, self.unsplit, self.window = leaf, fine, unsplit, window
        self.special = special
        self.kinds: dict[str, str] = {}
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.any_special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else regex.compile(r"(?!)")
        self.text = tiktoken.Encoding("text", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.run = tiktoken.Encoding("run", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (1 + max([*ranks.values(), *special.values()], default=-1))
        for b, i in ranks.items():
            self.bytes[i] = b
        for t, i in special.items():
            self.bytes[i] = t.encode()
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def array(self, text: str) -> np.ndarray:
        """One leaf: in one go, or as a tree of its own if a word is very long."""
        if len(text) <= self.fine or max(map(len, text.split()), default=0) <= self.fine:
            return self.text.encode_to_numpy(text, allowed_special="all")  # no list of numbers: a batch has millions
        return np.array(self.concatenate([(t, self.text.encode(t, allowed_special="all")) for t in self.cut(text, self.fine)]), np.uint32)

    def arrays(self, texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[np.ndarray]:
        """Ids of each text, encoded in one go, where every distinct word of a run of texts is encoded once."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + run_bytes, "right")))
            if b > a + 1 and not any(" " in t for t in self.special):
                yield from self.by_words(texts.slice(a, b - a))
            else:
                yield from (self.text.encode_to_numpy(t.as_py(), allowed_special="all") for t in texts.slice(a, b - a))
            a = b

    def by_words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The pre-tokenizer splits before a space that something else than white space follows, whatever comes before: white space
        ahead of it leaves its last character. So the ids of a text are those of its words, each with the space before it. A text in
        which white space or a special string follows a space, or that ends with one, is encoded as it is."""
        split = pc.split_pattern(texts, " ")
        at, words = split.offsets.to_numpy(), split.values.dictionary_encode()
        codes, distinct = words.indices.to_numpy(), words.dictionary
        odd = pc.is_in(pc.utf8_slice_codeunits(distinct, 0, 1), pa.array(["", *WHITE_SPACE]))
        for t in self.special:
            odd = pc.or_(odd, pc.match_substring(distinct, t))
        plain = ~odd.to_numpy(zero_copy_only=False)
        good = distinct.filter(pc.invert(odd))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(good)], pa.int32()), good), " ")[0].as_py()
        ids = self.text.encode_to_numpy(f" {joined}", allowed_special="all") if len(good) else np.empty(0, np.uint32)
        borders = np.cumsum(pc.binary_length(good).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), borders) + 1
        first, count = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        first[plain] = np.concatenate([[0], ends])[:-1]
        count[plain] = ends - first[plain]
        a = 0
        while a < len(texts):
            # some texts at a time, or the places of all ids would be held at once
            b = max(a + 1, int(np.searchsorted(at, at[a] + GROUP_WORDS, "right")) - 1)
            heads, here = at[a:b] - at[a], codes[at[a] : at[b]]
            other = np.add.reduceat(~plain[here], heads, dtype=np.int64) - ~plain[here[heads]]
            n = count[here]
            n[heads] = 0  # a head has no space before it
            upto = np.cumsum(n)
            places = np.repeat(first[here] - upto + n, n)
            places += np.arange(len(places))
            found = ids[places]
            cuts = [*upto[heads].tolist(), len(found)]
            for i, head in enumerate(distinct.take(pa.array(here[heads])).to_pylist()):
                if other[i] or self.any_special.search(head):
                    yield self.text.encode_to_numpy(texts[a + i].as_py(), allowed_special="all")
                else:
                    yield np.concatenate([self.text.encode_to_numpy(head, allowed_special="all"), found[cuts[i] : cuts[i + 1]]])
            a = b

    def direct(self, text: str) -> list[int]:
        return self.array(text).tolist()

    def cut(self, text: str, size: int) -> list[str]:
        """Leaves of a text; no cut falls into a special string."""
        out, a = [], 0
        longest = max(map(len, self.special), default=0)
        while len(text) - a > size:
            b = a + size
            for m in self.any_special.finditer(text, max(a, b - longest), min(len(text), b + longest)):
                if m.start() < b < m.end():
                    b = m.end()
            out.append(text[a:b])
            a = b
        return [*out, text[a:]]

    def kind(self, c: str) -> str:
        if c not in self.kinds:
            self.kinds[c] = kind_of(c)
        return self.kinds[c]

    def splits(self, text: str, p: int) -> bool:
        """Whether the pre-tokenizer splits before ``text[p]`` whatever comes before and after the two characters."""
        before, after = self.kind(text[p - 1]), self.kind(text[p])
        if before == "space":
            return False
        return after == "space" or before != after and text[p - 1] != "'"

    def last_split(self, text: str) -> int:
        floor = 0
        for m in self.any_special.finditer(text):
            floor = m.end()
        return next((p for p in range(len(text) - 1, floor, -1) if self.splits(text, p)), floor)

    def first_split(self, text: str) -> int:
        m = self.any_special.search(text)
        ceiling = m.start() if m else len(text)
        return next((p for p in range(1, ceiling) if self.splits(text, p)), ceiling)

    def borders(self, ids: list[int]) -> list[int]:
        return np.cumsum([0, *(len(self.bytes[i]) for i in ids)]).tolist()

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
        (a_text, a), (b_text, b) = left, right
        if not a_text or not b_text:
            return a_text + b_text, a + b
        s, e = self.last_split(a_text), self.first_split(b_text)
        head, tail = a_text[s:], b_text[:e]
        # tokens of the stretch on each side: both splits are token borders
        na = self._tokens_of(len(head.encode("utf-8", "surrogatepass")), reversed(a))
        nb = self._tokens_of(len(tail.encode("utf-8", "surrogatepass")), b)
        a, middle_a = a[: len(a) - na], a[len(a) - na :]
        middle_b, b = b[:nb], b[nb:]
        if not head or not tail:  # a special string is next to the cut
            middle = middle_a + middle_b
        elif len(head) + len(tail) <= self.unsplit:
            middle = self.text.encode_ordinary(head + tail)
        else:
            middle = self.join_unsplit(head, middle_a, tail, middle_b)
        return a_text + b_text, a + middle + b

    def _tokens_of(self, size: int, ids) -> int:
        n = 0
        for i in ids:
            if size <= 0:
                break
            size -= len(self.bytes[i])
            n += 1
        return n

    def join_unsplit(self, head: str, a: list[int], tail: str, b: list[int]) -> list[int]:
        """Tokens of ``head + tail`` from those of both, where both ends are splits and hardly any other split lies between."""
        whole = (head + tail).encode("utf-8", "surrogatepass")
        cut = len(head.encode("utf-8", "surrogatepass"))
        a_at, b_at = self.borders(a), [cut + x for x in self.borders(b)]
        # the pieces next to the cut, as each side alone has them
        a_piece = cut - len(self.split.findall(head)[-1].encode("utf-8", "surrogatepass"))
        b_piece = cut + len(self.split.match(tail).group().encode("utf-8", "surrogatepass"))
        out: list[int] = []
        x = 0
        for piece in self.split.findall(head + tail):
            y = x + len(piece.encode("utf-8", "surrogatepass"))
            # borders inside this piece that belong to a piece of one side which begins or ends where this one does
            lefts = [p for p in a_at if x <= p < min(y, cut)] if x == a_piece else []
            rights = [p for p in b_at if max(x, cut) < p <= y] if y == b_piece else []
            out += self.encode_piece(whole, x, y, lefts, rights, a, a_at, b, b_at)
            x = y
        return out

    def raw(self, data: bytes) -> list[int]:
        """BPE of bytes that are one piece."""
        return self.run._encode_single_piece(data) if data else []

    def encode_piece(self, whole: bytes, x: int, y: int, lefts: list[int], rights: list[int], a, a_at, b, b_at) -> list[int]:
        if y - x <= self.unsplit:
            return self.raw(whole[x:y])
        width = self.window
        while True:
            u = lefts[-width] if len(lefts) > width else x
            v = rights[width - 1] if len(rights) > width else y
            found = self.raw(whole[u:v])
            i = a_at.index(u) if u > x else None
            j = b_at.index(v) if v < y else None
            if (i is None or found[0] == a[i]) and (j is None or found[-1] == b[j - 1]):
                before = a[a_at.index(x) : i] if i is not None else []
                after = b[j : b_at.index(y)] if j is not None else []
                return before + found + after
            width *= 2

    def concatenate(self, leaves: list[tuple[str, list[int]]]) -> list[int]:
        """Join neighbours up a tree."""
        while len(leaves) > 1:
            joined = [self.join(leaves[i], leaves[i + 1]) for i in range(0, len(leaves) - 1, 2)]
            leaves = joined + leaves[len(leaves) - len(leaves) % 2 :]
        return leaves[0][1] if leaves else []

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.direct(text)
        return self.concatenate([(t, self.direct(t)) for t in self.cut(text, self.leaf)])


class Decoder:
    """Token bytes in one array, so that many ids become bytes in a few array operations."""

    def __init__(self, pieces: list[bytes]) -> None:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(lengths) - lengths
        self.lengths = lengths
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def bytes(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        total = int(n.sum())
        shift = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n)
        return self.data[np.arange(total) + shift]

    def text(self, ids: np.ndarray, step: int = 1 << 18) -> str:
        parts = [self.bytes(ids[i : i + step]).tobytes() for i in range(0, len(ids), step)]
        return b"".join(parts).decode("utf-8", "replace")


def int_lists(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate([np.empty(0, np.uint32), *lists]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


class Bpe:
    """The operator: a vocabulary, broadcast once, and DataFrame functions over it."""

    def __init__(self, spark: SparkSession, path: str | None = None, leaf: int = LEAF, fine: int = FINE, unsplit: int = UNSPLIT, window: int = WINDOW) -> None:
        self.leaf = leaf
        shared = spark.sparkContext.broadcast((*read_vocabulary(path or public_tokenizers.path(VOCABULARY)), leaf, fine, unsplit, window))
        key = f"{spark.sparkContext.applicationId}/{id(shared)}"

        def codec() -> Codec:
            # one per worker process, kept on a module that every process has
            held = sys.modules["tiktoken"].__dict__.setdefault("_held_codecs", {})
            if key not in held:
                held.clear()
                made = Codec(*shared.value)
                held[key] = made, Decoder(made.bytes)
            return held[key]

        self.codec = codec

    def encode(self, df: DataFrame, text: str, ids: str = "ids", intact: str | None = None) -> DataFrame:
        """``df`` with the column ``ids`` (array of int) at its end; row order is not kept. With ``intact`` a boolean of that name
        follows: whether the ids decode to the text. It is told where the text is encoded, so no second worker holds the tokens."""
        codec, names = self.codec, df.columns
        plain = df.toDF(*[f"c{i}" for i in range(len(names))])
        column = F.coalesce(F.col(f"c{names.index(text)}").cast("string"), F.lit(""))

        @F.arrow_udf("array<int>")
        def whole(texts: pa.Array) -> pa.Array:
            c, _ = codec()
            return int_lists([c.array(t.as_py()) for t in texts])

        @F.arrow_udf("array<string>")
        def leaves(texts: pa.Array) -> pa.Array:
            c, _ = codec()
            return pa.array([c.cut(t, c.leaf) for t in texts.to_pylist()], pa.list_(pa.string()))

        @F.arrow_udf("struct<ids: array<int>, intact: boolean>")
        def checked(texts: pa.Array) -> pa.Array:
            c, decoder = codec()
            lists, same = [], []
            for t in texts:
                lists.append(c.array(t.as_py()))
                same.append(decoder.text(lists[-1]) == t.as_py())
            return pa.StructArray.from_arrays([int_lists(lists), pa.array(same, pa.bool_())], ["ids", "intact"])

        is_long = F.length(column) > self.leaf
        if intact is None:
            short = plain.filter(~is_long).withColumn("ids", whole(column))
        else:
            made = plain.filter(~is_long).withColumn("made", checked.asNondeterministic()(column))
            short = made.select(*plain.columns, "made.ids", "made.intact")
        # the other columns of a long row travel with its first leaf; its number is unique within this plan
        row = F.struct(*[f"c{i}" for i in range(len(names)) if i != names.index(text)], F.col(f"c{names.index(text)}").isNull().alias("none"))
        cut = plain.filter(is_long).select(F.monotonically_increasing_id().alias("row"), row.alias("kept"), leaves(column).alias("leaves"))
        spread = cut.select("row", "kept", F.posexplode("leaves").alias("leaf_no", "leaf")).select(
            "row", F.when(F.col("leaf_no") == 0, F.col("kept")).alias("kept"), "leaf_no", "leaf"
        )
        encoded = spread.repartition(F.col("row"), F.col("leaf_no")).withColumn("ids", whole(F.col("leaf")))
        order = [f"c{i}" for i in range(len(names))]
        out_schema = T.StructType([T.StructField("kept", encoded.schema["kept"].dataType), T.StructField("text", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())), *([T.StructField("intact", T.BooleanType())] if intact else [])])
        out_arrow = to_arrow_schema(out_schema)

        def up_the_tree(rows: pa.Table) -> pa.Table:
            c, decoder = codec()
            rows = rows.sort_by("leaf_no")
            texts = rows["leaf"].to_pylist()
            ids = c.concatenate(list(zip(texts, rows["ids"].to_pylist())))
            kept = rows["kept"].combine_chunks().slice(0, 1)
            whole_text, found = "".join(texts), np.array(ids, np.uint32)
            checks = [pa.array([decoder.text(found) == whole_text], pa.bool_())] if intact else []
            return pa.Table.from_arrays([kept, pa.array([whole_text], pa.string()), int_lists([found]), *checks], schema=out_arrow)

        joined = encoded.groupBy("row").applyInArrow(up_the_tree, out_schema)
        at = names.index(text)
        found = ["ids", "intact"] if intact else ["ids"]
        long = joined.select(*[F.col("text").alias(x) if i == at else F.col(f"kept.{x}").alias(x) for i, x in enumerate(order)], *found)
        return short.select(*order, *found).union(long).toDF(*names, ids, *([intact] if intact else []))

    def decode(self, ids):
        """Text of a column of id arrays."""
        codec = self.codec

        @F.arrow_udf("string")
        def text(lists: pa.Array) -> pa.Array:
            _, decoder = codec()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            return pa.array([decoder.text(values[x:y]) for x, y in zip(offsets[:-1], offsets[1:])], pa.string())

        return text(ids)


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row, ``doc_id`` being the column ``key``."""
    bpe = Bpe(df.sparkSession, path)
    encoded = bpe.encode(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


@query("op5_bpe")
def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"))
