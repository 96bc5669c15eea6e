"""Language identification by compression.

Each language has a zstandard compressor whose raw-content dictionary is text of that language. A
text is compressed by each of them, in blocks so that the dictionary and not the text itself does
the work throughout, and the language with the smallest sum of sizes is chosen. The text is rejected
when the runner-up is hardly larger.

Learning takes a bounded sample: of each language the `SAMPLE_ROWS` rows with the least hash, and
`DICTIONARY_BYTES` of their words. Every text gives the same number of first bytes, or all it has: what short texts
leave of their shares goes to the longer ones. The executors cut, so the driver gets no more than that, however long
texts are. The number of languages is that of the labels.

Defined cases: a null text and a text without a letter are `und`, rejected, with score 0, as is any text
where there is no labelled row; equal sizes go to the language with more learning rows, then to the first
by name; repeated rows of the learning table count once; rows with a null language are not learned from.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch, small_side, written

SAMPLE_ROWS = 128
#: Counts by language are broadcast up to so many languages.
LANGUAGES = 100_000
DICTIONARY_BYTES = 110_000
BLOCK_BYTES = 4_096
#: Texts up to this size are matched by hash tables alone, longer ones by hash chains.
SHORT_BYTES = 400
#: A text is rejected when the runner-up is less than this share larger.
LEAST_MARGIN = 0.001
UNKNOWN = "und"

#: ASCII letters in lower case and all bytes of other characters stay; the rest separates words.
WORD_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else b if b >= 128 else 32 for b in range(256))


def words_only(text: str) -> bytes:
    """The words of a text in lower case, one space between them, a word that repeats at once written once."""
    words = text.lower().encode().translate(WORD_BYTES).split()
    return b" %s " % b" ".join([word for word, _ in groupby(words)])


class Languages:
    """A compressor for each language. `samples`: language -> texts; the commonest language first."""

    def __init__(self, samples: list[tuple[str, list[str]]]):
        self.names = [name for name, _ in samples]
        self.short, self.long = [], []
        for _, texts in samples:
            content = b"".join(words_only(t) for t in texts)[:DICTIONARY_BYTES]
            for kept, more in ((self.short, {}), (self.long, {"strategy": zstandard.STRATEGY_GREEDY, "search_log": 3})):
                settings = zstandard.ZstdCompressionParameters.from_level(
                    3, source_size=BLOCK_BYTES, dict_size=len(content), min_match=3, write_content_size=False,
                    write_checksum=False, write_dict_id=False, **more,
                )
                # a raw dictionary has at least 8 bytes
                dictionary = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=settings)
                kept.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary).compress)

    def sizes(self, text: str) -> list[int]:
        words = words_only(text)
        blocks = [words[at : at + BLOCK_BYTES] for at in range(0, len(words), BLOCK_BYTES)]
        return [sum(len(c(b)) for b in blocks) for c in (self.short if len(words) <= SHORT_BYTES else self.long)]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin. The margin is by what share the runner-up is larger."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        first, second = (sorted(sizes) * 2)[:2] if len(sizes) > 1 else (sizes[0], 2 * sizes[0])
        margin = (second - first) / second
        return self.names[sizes.index(first)], 0.5 + 0.5 * min(1.0, margin / 0.1), margin


def learning_sample(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most `rows` different texts of each language, the least by hash, with the number of all its rows."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    hashed = known.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"))
    by_text = written(hashed.groupBy("lang", "hash").agg(F.count("*").alias("copies")), "hashes")
    counts = by_text.groupBy("lang").agg(F.sum("copies").alias("total"), F.count("*").alias("texts"))
    # hashes are even: of a language's, about 8 x rows lie below this bound, and fewer than `rows` never
    bound = F.when(F.col("texts") > 8 * rows, -(2.0**63) + 2.0**64 * 8 * rows / F.col("texts")).otherwise(2.0**63)
    low = by_text.drop("copies").join(small_side(counts, LANGUAGES), "lang").where(F.col("hash").cast("double") <= bound)
    by_hash = Window.partitionBy("lang").orderBy("hash")
    picked = low.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= rows).drop("place", "texts")
    # `picked` has `rows` rows a language, whatever the corpus
    texts = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    return texts.join(F.broadcast(picked), ["lang", "hash"]).groupBy("lang", "hash").agg(
        F.first("text").alias("text"), F.first("total").alias("total")
    )


def fair_words(sample: DataFrame, most: int = DICTIONARY_BYTES) -> DataFrame:
    """`sample` with the words of each text in place of the text, cut so that those of a language have `most` bytes
    together and no text is cut shorter than another that is cut."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [words_only(x)[:most] for x in batch.column(3).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(words, pa.binary())], names=["lang", "hash", "total", "words"]
            )

        return one

    # a few rows at once: texts of the sample may be very long
    cut = per_batch(
        sample.select("lang", "hash", "total", "text"), "lang string, hash long, total long, words binary", make, most_rows=8
    )
    # `SAMPLE_ROWS` rows a language: the level of the shares is the largest that some text, shortest first, leaves
    by_size = Window.partitionBy("lang").orderBy("size", "hash")
    before = F.coalesce(F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.count("*").over(Window.partitionBy("lang")) - F.row_number().over(by_size) + 1
    shares = cut.withColumn("size", F.octet_length("words")).withColumn("share", F.floor((most - before) / left))
    level = F.max("share").over(Window.partitionBy("lang")).cast("int")
    return shares.withColumn("level", level).select("lang", "hash", "total", F.expr("substring(words, 1, level)").alias("words"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, list[str]]]:
    """Samples for `Languages`: the bounded sample comes to the driver, the commonest language first."""
    rows = fair_words(learning_sample(docs, text, lang)).orderBy("lang", "hash").collect()
    totals = {r["lang"]: r["total"] for r in rows}
    order = sorted(totals, key=lambda name: (-totals[name], name))
    return [(name, [bytes(r["words"]).decode("utf-8", "ignore") for r in rows if r["lang"] == name]) for name in order]


def identify(
    docs: DataFrame, samples: list[tuple[str, list[str]]], text: str = "text", keep_text: bool = False
) -> DataFrame:
    """`docs` with `lang_pred`, `score`, `margin` and `rejected`, in place of `text` or behind it."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    added = ["lang_pred", "score", "margin", "rejected"]
    carried = [c for c in docs.columns if c not in (text, *added)]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("text"))
    columns = [*carried, "text"] if keep_text else carried
    schema = kinds(prepared, columns, "lang_pred string, score double, margin double, rejected boolean")

    def make():
        languages = Languages(shared.value)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [languages.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            names, scores, margins = ([x[k] for x in found] for k in range(3))
            rejected = [name == UNKNOWN or margin < LEAST_MARGIN for name, _, margin in found]
            new = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], *new, pa.array(rejected, pa.bool_())], names=[*columns, *added]
            )

        return one

    return per_batch(prepared, schema, make)
