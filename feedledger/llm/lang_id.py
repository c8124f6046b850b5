"""Language identification by compression.

Each language has a raw-content zstandard dictionary made from a bounded sample of its labelled
texts. A text is lower-cased, its runs of non-letters become single spaces, and it is cut into
pieces of ``PIECE`` bytes (all of it, so evidence adds up over a long text); every piece is
compressed with each dictionary and the language with the fewest bytes wins. The margin is the share of bytes saved against the runner-up. A text with a narrow margin is judged
again at ``SECOND_LEVEL``, which finds shorter matches (a short text's sizes differ by few bytes); if
the margin stays narrow the text is marked ``rejected``.

Sample bound (documented parameters): ``SAMPLE_DOCS`` labelled texts a language, in the order of a
hash of their id, ``SAMPLE_CHARS`` code points of each. Every text is classified whole.

Cases: a null text, or one without a letter, gives ``und`` with score 0, rejected; with no labelled
text at all every text is ``und``; a tie goes to the language with more labelled texts, then to the
smaller name, and is rejected unless only one language exists; repeated rows are classified alike;
extra columns are ignored by ``predict``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

UNDETERMINED = "und"
SAMPLE_DOCS = 256
SAMPLE_CHARS = 1024
PIECE = 4096
LEVEL = 3
SECOND_LEVEL = 19
#: A text whose best dictionary saves less than this share of bytes against the next is rejected.
MIN_MARGIN = 0.005

#: Runs that hold every letter, and numeric signs that are none (as a half or a Roman numeral).
_LETTERS = re.compile(r"[^\W\d_]+")
_REST = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    return any(c.isalpha() for run in _LETTERS.finditer(text) for c in run.group())


def letters(text: str) -> bytes:
    """What is compressed: lower-cased letters, other runs as one space."""
    return _REST.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def sample(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           n_docs: int = SAMPLE_DOCS, n_chars: int = SAMPLE_CHARS) -> list[tuple[str, int, bytes]]:
    """(language, number of labelled texts, dictionary content), ascending by language.

    At most ``n_docs * n_chars`` code points a language reach the driver; the number of texts is
    counted over all rows.
    """
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("o"), F.col(id_col).alias("i"),
        F.substring(F.col(text_col), 1, n_chars).alias("t"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    first = rows.withColumn("rn", F.row_number().over(Window.partitionBy("lang").orderBy("o", "i", "t"))).filter(F.col("rn") <= n_docs)
    texts: dict[str, list[str]] = {}
    for r in first.orderBy("lang", F.col("rn").desc()).select("lang", "t").collect():
        texts.setdefault(r["lang"], []).append(r["t"])
    n = {r["lang"]: r["n"] for r in counts.collect()}
    return [(lang, n[lang], letters("\n".join(texts[lang]))) for lang in sorted(texts)]


class Model:
    """The compressors of one worker; ``sizes`` gives a text's bytes per language."""

    def __init__(self, dictionaries: list[tuple[str, int, bytes]]):
        import zstandard

        order = sorted(dictionaries, key=lambda d: (-d[1], d[0]))  # a tie takes the first
        self.langs = [d[0] for d in order]

        def compressors(level: int) -> list:
            out = []
            for _, _, content in order:
                own = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=level)
                out.append(zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_dict_id=False).compress)
            return out

        self.compressors = functools.cache(compressors)

    def sizes(self, text: str, level: int = LEVEL) -> list[int]:
        raw = letters(text)
        pieces = [raw[i: i + PIECE] for i in range(0, len(raw), PIECE)]
        return [sum(len(f(p)) for p in pieces) for f in self.compressors(level)]

    @staticmethod
    def best(sizes: list[int]) -> tuple[int, float]:
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = min(s for i, s in enumerate(sizes) if i != best)
        return best, (rest - sizes[best]) / rest

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)."""
        if not self.langs or not text or not has_letter(text):
            return UNDETERMINED, 0.0, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, 1.0, False
        best, margin = self.best(self.sizes(text))
        if margin < MIN_MARGIN:
            best, margin = self.best(self.sizes(text, SECOND_LEVEL))
        return self.langs[best], min(1.0, 0.5 + 5 * margin), margin, margin < MIN_MARGIN


def predict(docs: DataFrame, dictionaries: list[tuple[str, int, bytes]], text_col: str = "text",
            names: tuple[str, str, str, str] = ("lang_pred", "score", "margin", "rejected")) -> DataFrame:
    """``docs`` with four more columns named ``names`` (they replace columns of that name)."""
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages * n_docs * n_chars at most
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in zip(names, ("string", "double", "double", "boolean")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        model = Model(shared.value)
        for b in batches:
            found = [model.classify(t) for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            more = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *names])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return C.remainder(doc_id, 4) == 2
