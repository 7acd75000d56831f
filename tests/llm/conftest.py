import public_tokenizers
import pyarrow as pa
import pytest

#: Columns whose names the operators use themselves.
CLASHES = ["words", "salt", "rank", "failed", "score", "lang_pred", "n", "key", "block", "rep", "digest", "component_id", "_row", "kind"]
PROSE = "the river runs past the old mill and under the stone bridge where children fish in summer while their parents talk about the harvest and the weather"
ODD = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, PROSE), (5, PROSE.upper()), (6, PROSE + " again"), (7, PROSE), (7, PROSE), (None, PROSE + " without an id"), (8, "a"), (9, "?!"),
    (10, "x" * 3000), (11, "Üben ñandú ça <|endoftext|> é́ 日本 \U0001f600 don't 12,5"), (12, " ".join(f"w{i}" for i in range(60_000))),
]


@pytest.fixture(scope="session")
def vocab():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, None if i == 4 else "en", "s", None, *range(len(CLASHES))) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASHES))


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="session")
def library(vocab):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab)
    t.no_truncation()
    t.no_padding()
    return t
