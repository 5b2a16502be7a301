"""The operators in a session whose workers start in another folder and do not know the package."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from clickweave.session import local_session
spark = local_session(2, shuffle_partitions=2)
sys.path.remove({root!r})
docs = spark.createDataFrame([(i, "some words in a text, more or less " * (i % 3 + 1) + "+1 555 123 4567 " * (i % 2), "en", "s", 1) for i in range(8)],
                             "doc_id bigint, text string, lang string, source string, n_chars bigint")
from clickweave.llm import align, html, merkle, minhash, pii, quality, records
import public_tokenizers as P
assert html.extract(docs.selectExpr("doc_id AS page_id", "'u' AS url", "concat('<p>', text) AS html")).where("n_chars > 0").count() == 8
assert minhash.near_duplicates(docs).where("kept").count() < 8
manifest = records.write_records(docs, P.path("word_bpe_49k.json"))
assert records.read_records(manifest).count() == records.read_index(manifest).count() == records.read_shuffled(manifest).count() == 8
assert pii.find(docs, pii.SpanField()).where("n_phone > 0").count() == 4
model = quality.OrdinalModel(*(quality.np.empty(0, t) for t in ("int64", "float64")), quality.np.zeros(quality.SHAPES), quality.np.array([-1.0, 0.0]))
assert quality.score(docs, model).count() == quality.selected(docs, model).count() == 8
assert merkle.manifest(merkle.document_leaves(docs)).count() == 8
assert align.cross_aligned(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).where("n_links > 0").count() == 8
print("all well")
"""


def test_workers_need_not_know_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(CODE.format(root=root))
    got = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all well" in got.stdout, got.stderr[-3000:]
