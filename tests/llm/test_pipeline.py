"""The pipeline's stages one by one, each against brute force on what the one before it kept."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from tempestry.llm import quality
from tempestry.llm.common import table
from tests.llm.conftest import ODD
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_mixing import brute_targets
from tests.llm.test_quality import brute as measures


def test_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == 4 or docs.columns == columns, name
        kept.append(docs.collect())
    good, lined, single, mixed, packed = kept

    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in judged.where("kept").collect())

    want = brute_lines([(r.doc_id, r.text) for r in good])
    assert Counter((r.doc_id, r.text) for r in lined) == Counter((k[0], k[3]) for k in want.elements())
    assert all(r.n_chars == len(r.text) for r in lined)

    components = brute_components([(r.doc_id, r.text) for r in lined])
    assert sorted(r.doc_id for r in single) == sorted(doc for doc, _, least in components.elements() if doc == least)

    size, source = {r.doc_id: len(r.text.encode().split()) for r in single}, {r.doc_id: r.source for r in single}
    sizes, taken = defaultdict(int), defaultdict(int)
    for doc, words in size.items():
        sizes[source[doc]] += words
    copies = Counter(r.doc_id for r in mixed)
    for doc, n in copies.items():
        taken[source[doc]] += n * size[doc]
        assert n <= 2
    for name, target in brute_targets(sizes).items():
        assert abs(taken[name] - target) <= max(size[d] for d in size if source[d] == name) / 2 + 1e-6

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for r in mixed:
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            piece = ids[start : start + 4096]
            pieces[(r.doc_id, k, start, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces


@pytest.fixture
def chained(spark, sf_dir, tmp_path):
    def run(docs):
        """What each stage returns, each from what the one before it wrote."""
        found = []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{len(list(tmp_path.iterdir()))}-{k}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            found.append(docs)
        return found

    return run


def test_stages_take_odd_rows(documents, chained):
    """Null ids, texts and sources, repeated rows and ids, blank and very long texts, and columns of clashing names."""
    prose = [" ".join(f"w{(i * 31 + k * k) % 977}" for k in range(40)) for i in range(12)]
    shared = "one line that very many documents share, word for word"
    rows = ODD + [(100 + i, f"{p}\n{shared}") for i, p in enumerate(prose)]
    rows += [(None, prose[0] + " and more words than that one has"), (None, prose[0]), (None, prose[0]), (101, f"{prose[1]}\n{shared}")]
    rows += [(200, prose[2], None, None), (201, prose[3] + " " + prose[4], "xx", "other"), (300, "short text of few words")]
    rows += [(400, " ".join(f"v{i}" for i in range(30_000)))]
    docs = documents(rows)
    good, lined, single, mixed, packed = chained(docs)
    assert all(df.columns == docs.columns for df in (good, lined, single, mixed))

    kept = [(r.doc_id, r.text) for r in good.collect()]
    measured = [(r[0], r[1], measures(r[1])) for r in rows]
    assert Counter(kept) == Counter((doc, text) for doc, text, (n, *_, repeated) in measured if n >= 20 and 100 * repeated <= 30 * n)
    want = brute_lines(kept)
    assert Counter((r.doc_id, r.text) for r in lined.collect()) == Counter((k[0], k[3]) for k in want.elements())
    assert any(k[2] for k in want) and all(r.n_chars == len(r.text) for r in lined.collect())

    texts = [(r.doc_id, r.text) for r in lined.collect()]
    with_id = {doc for doc, _, least in brute_components(texts).elements() if doc is not None and doc == least}
    stay = Counter((r.doc_id, r.text) for r in single.collect())
    # Of rows that share an id each different text stays once; rows without id stay, equal texts once.
    assert stay == Counter({(doc, text) for doc, text in texts if doc is None or doc in with_id})
    copies = Counter((r.doc_id, r.text) for r in mixed.collect())
    assert set(copies) <= set(stay) and max(copies.values()) <= 2 and None in {doc for doc, _ in copies}
    pieces = Counter(r.doc_id for r in packed.collect() if r.piece == 0)
    assert pieces == Counter(doc for doc, _ in copies.elements())


def test_stages_take_empty_tables(documents, chained):
    docs = documents(ODD).limit(0)
    for found in chained(docs):
        assert found.count() == 0
    # Nothing passes the first stage.
    assert [df.count() for df in chained(documents([(1, None), (2, ""), (3, "few words")]))] == [0] * 5


def test_run_leaves_the_results_of_stages_only(spark, sf_dir):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "tempestry")
    before = set(shared.iterdir()) if shared.exists() else set()
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    left = {p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before}
    assert left == {*(f"pipeline-{name.replace(' ', '-')}" for name, _ in corpus_pipeline.STAGES[:-1]), "pieces", "piece-counts"}


def test_every_operator_is_registered():
    names = entry_module.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing",
    ]
