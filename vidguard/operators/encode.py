"""Text to unit vectors, with a pluggable batch encoder."""

import hashlib
import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .. import constants as K
from ..sources.vector_store import TEXT_HASH, VECTOR, VectorStore

# Called once per Python worker; gives a function from a list of texts to a float matrix.
EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]

BATCH = 64
# rows whose texts are compared before they are encoded
SAME_ROWS = 1024


def token_hash_encoder(dim: int = K.VECTOR_DIM) -> EncoderFactory:
    """Default encoder: token counts hashed into ``dim`` places. Needs no model weights."""

    def factory() -> Callable[[list[str]], np.ndarray]:
        places = _Places(dim)

        def encode(texts: list[str]) -> np.ndarray:
            words = [text.split() for text in texts]
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            found = np.fromiter(
                map(places.__getitem__, itertools.chain.from_iterable(words)),
                dtype=np.int64, count=int(lengths.sum()))
            cells = np.repeat(np.arange(len(texts)), lengths) * dim + found
            counts = np.bincount(cells, minlength=len(texts) * dim)
            return counts.reshape(len(texts), dim).astype(np.float64)

        return encode

    return factory


class _Places(dict):
    """Token -> place, remembered per worker up to a bounded number of tokens."""

    LIMIT = 100_000

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        place = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dim
        self[token] = place
        return place


# hash of a character n-gram: its bytes as digits of a number (base, prime), spread by a factor
GRAM_SIZES, GRAM_BASE, GRAM_PRIME, GRAM_FACTOR = (3, 4), 257, 2_147_483_647, 48_271
# bytes of texts hashed at once
_GRAM_BYTES = 1 << 20


def char_ngram_encoder(dim: int = K.VECTOR_DIM, sizes: Sequence[int] = GRAM_SIZES
                       ) -> EncoderFactory:
    """Encoder of character n-grams hashed into ``dim`` places; words that were respelt keep most.

    N-grams are those of the UTF-8 bytes of the text with a space at either end; an empty text has none.
    Texts are hashed together as one ragged array of bytes, by shifted sums, in windows of bounded size
    that overlap by the longest n-gram.
    """

    def factory() -> Callable[[list[str]], np.ndarray]:
        def encode(texts: list[str]) -> np.ndarray:
            parts = [b" " + t.encode("utf-8", "surrogatepass") + b" " if t else b"" for t in texts]
            flat = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            counts = np.zeros(len(texts) * dim)
            for at in range(0, len(flat), _GRAM_BYTES):
                stop = min(at + _GRAM_BYTES, len(flat))
                data = flat[at:stop + max(sizes) - 1].astype(np.int64)
                place = np.arange(at, stop)
                owner = np.searchsorted(ends, place, side="right")
                for n in sizes:
                    fits = place + n <= ends[owner]
                    value = _rolled(data, n)[:stop - at]
                    cells = owner[fits][:len(value)] * dim + value[fits[:len(value)]]
                    counts += np.bincount(cells, minlength=len(counts))
            return counts.reshape(len(texts), dim)

        def _rolled(data: np.ndarray, n: int) -> np.ndarray:
            """Places of the n-grams that start at every byte."""
            size = max(len(data) - n + 1, 0)
            total = np.zeros(size, np.int64)
            for k in range(n):
                total = (total * GRAM_BASE + data[k:k + size]) % GRAM_PRIME
            return total * GRAM_FACTOR % GRAM_PRIME % dim

        return encode

    return factory


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    norms[norms == 0] = 1.0
    return (matrix / norms[:, None]).astype(np.float32)


def encode_column(factory: EncoderFactory | None = None, keep_null: bool = False):
    """Arrow UDF text -> array<float>. NULL counts as '' unless it is to stay NULL."""
    factory = factory or token_hash_encoder()

    @F.arrow_udf(ArrayType(FloatType()))
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for texts in batches:
            yield _vectors_of(encode, texts if keep_null else texts.fill_null(""))

    return encoded


def _vectors_of(encode: Callable[[list[str]], np.ndarray], texts: pa.Array) -> pa.Array:
    """Unit vectors of the texts as one flat array, NULL for NULL; only ``BATCH`` texts are unpacked."""
    known = np.asarray(texts.is_valid())
    parts = (texts.slice(start, BATCH).drop_null().to_pylist()
             for start in range(0, len(texts), BATCH))
    made = [unit_rows(np.asarray(encode(part), dtype=np.float64)) for part in parts if part]
    flat = np.concatenate(made) if made else np.empty((0, 0), np.float32)
    ends = np.cumsum(known * flat.shape[1])
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat.ravel(), pa.float32()),
        mask=pa.array(~known))


def embed(df: DataFrame, text: str = "combined_text", out: str = "vector",
          factory: EncoderFactory | None = None) -> DataFrame:
    return df.withColumn(out, encode_column(factory)(F.col(text)))


def _medium_encoder(factory: EncoderFactory | None):
    """Arrow UDF of the three texts -> a struct of three vectors: one pass through Python."""
    factory = factory or token_hash_encoder()

    @F.arrow_udf(", ".join(f"{m} array<float>" for m in K.MEDIUMS))
    def encoded(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        encode = factory()
        for columns in batches:
            yield pa.concat_arrays([
                _medium_vectors(encode, [texts.slice(start, SAME_ROWS) for texts in columns])
                for start in range(0, max(len(columns[0]), 1), SAME_ROWS)])

    return encoded


def _medium_vectors(encode: Callable[[list[str]], np.ndarray], columns: list[pa.Array]) -> pa.Array:
    """A struct of vectors per row; a text that another medium or row has too is encoded once."""
    texts, rows = pa.concat_arrays(columns).dictionary_encode(), len(columns[0])
    vectors = _vectors_of(encode, texts.dictionary).take(texts.indices)
    return pa.StructArray.from_arrays(
        [vectors.slice(i * rows, rows) for i in range(len(columns))], names=list(K.MEDIUMS))


def embed_mediums(df: DataFrame, factory: EncoderFactory | None = None) -> DataFrame:
    """``<medium>_vec`` for each ``<medium>_text``; blank texts give NULL and never match."""
    texts = [F.when(F.trim(f"{m}_text") != "", F.col(f"{m}_text")) for m in K.MEDIUMS]
    made = df.withColumn("_vectors", _medium_encoder(factory)(*texts))
    return made.select(
        *[c for c in df.columns if c not in {f"{m}_text" for m in K.MEDIUMS}],
        *[F.col("_vectors")[m].alias(f"{m}_vec") for m in K.MEDIUMS])


def stored_vectors(texts: DataFrame, path: str, version: str,
                   factory: EncoderFactory | None = None) -> DataFrame:
    """(text_hash, vector) of the store at ``path``, after the vectors of new texts were added.

    ``texts``: a ``text`` column. Only texts that no generation of the encoder ``version`` holds are
    encoded; a repeated run, or one beside this one, leaves one vector per text. NULL and blank texts
    have no vector. The rows are those of one generation, whatever is added later.
    """
    store = VectorStore(texts.sparkSession, path, version)
    hashed = texts.where(F.trim("text") != "").select(F.sha2("text", 256).alias(TEXT_HASH), "text")
    number = store.merge(hashed, lambda new: embed(new, "text", VECTOR, factory))
    return store.read(number)


def embed_from_store(df: DataFrame, path: str, version: str,
                     factory: EncoderFactory | None = None) -> DataFrame:
    """``embed_mediums`` with vectors looked up in a store that is extended first."""
    named = df.select(*[F.col(f"{m}_text") for m in K.MEDIUMS])
    texts = named.unpivot([], [f"{m}_text" for m in K.MEDIUMS], "medium", "text").select("text")
    vectors = stored_vectors(texts, path, version, factory)
    for m in K.MEDIUMS:
        df = df.withColumn(TEXT_HASH, F.when(
            F.trim(f"{m}_text") != "", F.sha2(f"{m}_text", 256))).join(
            vectors.withColumnRenamed(VECTOR, f"{m}_vec"), on=TEXT_HASH, how="left").drop(TEXT_HASH)
    return df.drop(*[f"{m}_text" for m in K.MEDIUMS])


def model_matrix(
    df: DataFrame, numeric: Sequence[str] = (), vector: str = "vector", out: str = "x"
) -> DataFrame:
    """Embedding followed by the numeric features, as one array<float>."""
    numeric = list(numeric) or K.numeric_features()
    tail = F.array(*[F.col(c).cast("float") for c in numeric])
    return df.withColumn(out, F.concat(F.col(vector), tail))


def wrong_width(vector: Column, dim: int = K.VECTOR_DIM) -> Column:
    return F.coalesce(F.size(vector) != dim, F.lit(True))


def vector_shape_check(df: DataFrame, vector: str = "vector", dim: int = K.VECTOR_DIM) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(wrong_width(F.col(vector), dim).cast("long")), F.lit(0))
        .alias("violations"),
    )
