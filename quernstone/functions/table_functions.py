"""Table functions for SQL: sentences, fragments and entities of a text by lateral join.

    SELECT doc_id, pos, sentence FROM documents, LATERAL sentences(text, 'en')

They give what the DataFrame forms give and share their rules. A query over columns
is better served by those, which stay in the JVM or in Arrow; these are for callers
who have SQL alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

from quernstone.functions.sentences import OWN, sentences_of
from quernstone.operators.chunk import FRAGMENT, ChunkConfig, Chunker
from quernstone.operators.graph import ENTITIES, Dictionary, Recogniser
from quernstone.sources.extract import clean


def _need(name: str, argument: AnalyzeArgument, kind: type[DataType], what: str) -> None:
    if not isinstance(argument.dataType, kind):
        raise ValueError(f"{name}: {what} is {argument.dataType.simpleString()}, not {kind.__name__.removesuffix('Type').lower()}")


def sentences_function() -> type:
    """sentences(text [, language]): pos, sentence of the normalised text; a null or empty text has none."""

    schema = StructType.fromDDL("pos int, sentence string")  # parsed here: workers have no session

    class Sentences:
        @staticmethod
        def analyze(text: AnalyzeArgument, language: AnalyzeArgument | None = None) -> AnalyzeResult:
            _need("sentences", text, StringType, "the text")
            if language is not None and language.isConstantExpression and language.value not in OWN:
                raise ValueError(f"sentences: no rules for {language.value}; there are {sorted(OWN)}")
            return AnalyzeResult(schema)

        def eval(self, text: str | None, language: str | None = "es") -> Iterator[tuple[int, str]]:
            yield from enumerate(sentences_of(clean(text), language or "es"))

    return udtf(Sentences)


def fragments_function(config: ChunkConfig = ChunkConfig()) -> type:  # noqa: B008
    """fragments(doc_id, text [, target words [, language]]): the fragments of a text taken as one paragraph."""

    schema = StructType.fromDDL(FRAGMENT)

    class Fragments:
        @staticmethod
        def analyze(doc_id: AnalyzeArgument, text: AnalyzeArgument, target: AnalyzeArgument | None = None, language: AnalyzeArgument | None = None) -> AnalyzeResult:
            _need("fragments", text, StringType, "the text")
            if target is not None:
                _need("fragments", target, IntegralType, "the target")
            return AnalyzeResult(schema)

        def eval(self, doc_id: object, text: str | None, target: int | None = None, language: str | None = "es") -> Iterator[tuple]:
            body = clean(text)
            own = ChunkConfig(**{**config.__dict__, "target_words": config.target_words if target is None else target})
            block = {"text": body, "kind": "paragraph", "level": None, "path": [], "page": None, "atomic": False, "data": None, "sentences": sentences_of(body, language or "es")}
            for f in Chunker(own).fragments(str(doc_id), [block] if body else [], None, None):
                yield tuple(f.values())

    return udtf(Fragments)


def entities_function(dictionary: Dictionary) -> type:
    """entities(text): pos and the entities of a text in order."""
    schema = StructType.fromDDL(f"pos int, {ENTITIES}")

    class Entities:
        def __init__(self) -> None:
            self.own = Recogniser(dictionary)

        @staticmethod
        def analyze(text: AnalyzeArgument) -> AnalyzeResult:
            _need("entities", text, StringType, "the text")
            return AnalyzeResult(schema)

        def eval(self, text: str | None) -> Iterator[tuple]:
            for pos, e in enumerate(self.own.entities(text or "")):
                yield (pos, e["name"], e["kind"], e["start"], e["end"], e["origin"])

    return udtf(Entities)


def register(spark: SparkSession, dictionary: Dictionary = Dictionary(), config: ChunkConfig = ChunkConfig()) -> None:  # noqa: B008
    """Make ``sentences``, ``fragments`` and ``entities`` known to a session's SQL."""
    spark.udtf.register("sentences", sentences_function())
    spark.udtf.register("fragments", fragments_function(config))
    spark.udtf.register("entities", entities_function(dictionary))
