import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest

from tidemark.llm import exact, pii, queries
from tidemark.llm.common import table, written

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def test_stages_return_the_columns_of_documents_and_act(spark):
    docs = table(spark, SF, "documents")
    start = docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = written(stage(spark, docs, SF))
        assert done.schema.names == start.schema.names, name
        assert done.join(docs, "doc_id", "left_anti").isEmpty()
        sizes.append((docs.count(), done.count()))
        docs = done
    assert sizes[1][1] < sizes[1][0] and sizes[3][0] == sizes[3][1]
    assert exact.exact_groups(docs).filter("not kept").isEmpty()
    assert pii.personal_data(docs).filter("n_email + n_ip + n_card + n_phone > 0").isEmpty()
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_no_rows_go_through_all_stages(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
    assert docs.isEmpty()


def test_odd_rows_and_clashing_columns_go_through_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, spans string, node long, _id int, _text string, _doc string, digest string"
    rest = (None, None, None, 0.5, "k", "s", 7, 1, "t", "d", "g")
    words = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", " \n", "one", "one", "mail a@b.cd now", words, words + " more", words, "long " * 30000, "x" * 50000, None]
    rows = [(k if k % 5 else None, t, *rest) for k, t in enumerate(texts)] + [(8, words, *rest)]
    docs = written(spark.createDataFrame(rows, schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = written(stage(spark, docs, SF))
        assert done.schema.names == docs.schema.names
        docs = done
    got = [(r["doc_id"], r["text"], r["kept"], r["_text"]) for r in docs.collect()]
    by_text = {(t or "")[:12]: (i, k, u) for i, t, k, u in got}
    assert len(got) == len(by_text) == 7
    assert by_text["mail <email>"[:12]][1:] == ("k", "t") and by_text[words[:12]][0] == 6 and by_text["one"][0] == 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.filter("start = 0").count() == 7


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


GONE = {"": 14, "tidemark/llm": 0, "tidemark/llm,corpus_pipeline.py": 0, "corpus_pipeline.py": 13}


@pytest.mark.parametrize("gone", GONE)
def test_entry_in_a_copy_without_this_package(gone, tmp_path):
    left_out = shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.md")
    shutil.copytree(REPO, tmp_path / "copy", ignore=left_out)
    for name in filter(None, gone.split(",")):
        path = tmp_path / "copy" / name
        shutil.rmtree(path) if path.is_dir() else path.unlink()
    code = """
import __spark_entry__ as e
names = e.queries()
print(len(names), sum(n.startswith("op") or n == "pipeline" for n in names), len(e.oracle_sql()))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True).stdout.split()
    assert int(out[1]) == GONE[gone] and int(out[0]) > 100


def test_an_error_inside_the_package_is_not_swallowed(tmp_path):
    shutil.copytree(REPO, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.md"))
    (tmp_path / "copy/tidemark/llm/queries.py").write_text("import no_such_module")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert run.returncode and "no_such_module" in run.stderr
