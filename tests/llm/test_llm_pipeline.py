import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from strata.session import checkpoint_root
import public_tokenizers as P
from strata.llm import quality, queries, templates
from strata.llm.common import write_table

import cases
from test_llm_simhash import plain_components, plain_print
from test_llm_templates import plain_pairs

SMALL = "/root/testdata/sf0.001"


def plain_lines(docs, min_sites=10):
    """doc_id -> text without the lines that many sites carry."""
    sites, rows = {}, {}
    for text, site in zip(docs.text, docs.source):
        rows[text] = rows.get(text, 0) + 1
        for line in text.split("\n"):
            if line.strip(" "):
                sites.setdefault(line, set()).add(site)
    spread = {line for line, s in sites.items() if len(s) >= min_sites}
    out = {}
    for i, text in zip(docs.doc_id, docs.text):
        lines = text.split("\n")
        content = [x for x in lines if x.strip(" ")]
        whole = rows[text] > 1 and all(x in spread for x in content)
        out[i] = text if whole or not spread & set(lines) else "\n".join(x for x in lines if x not in spread)
    return out


def test_stages_on_awkward_rows(spark):
    for docs in (cases.documents(spark), cases.empty(spark)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = write_table(stage(spark, docs, SMALL), f"awkward-{name}")
            if name != "sentencepiece":
                assert out.schema.simpleString() == docs.schema.simpleString(), name
                again = {tuple(r) for r in write_table(stage(spark, docs.repartition(2), SMALL), name).collect()}
                assert {tuple(r) for r in out.collect()} == again         # however rows are dealt
            assert out.count() <= docs.count() or name == "sentencepiece"
            if name in ("line_dedup", "sentencepiece"):
                assert out.count() == docs.count()
            docs = out
        assert docs.count() < rows or rows == 0


def test_stages_keep_all_rows_that_are_fine(spark):
    """Null, empty and repeated rows through the stages that judge them, one by one."""
    docs = cases.documents(spark)
    texts = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text is not None)
    lines = corpus_pipeline.line_dedup(spark, docs, SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in lines if r.doc_id is not None and r.text is not None) == texts
    assert sum(r.text is None for r in lines) == 1
    clean = corpus_pipeline.decontamination(spark, docs, SMALL)
    assert clean.count() == docs.count()
    kept = corpus_pipeline.simhash_dedup(spark, docs, SMALL).collect()
    assert len([r for r in kept if r.text in (None, "", " ", "\n\n")]) == 1      # no words: one group


def test_stages_against_plain_versions(spark):
    docs = queries.table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = write_table(stage(spark, docs, SMALL), name)
        kept[name] = (before.toPandas(), docs.toPandas())
        if name != "sentencepiece":
            assert docs.columns == columns
    before, after = kept["quality_rules"]
    judged = queries.op8_quality_rules(spark, SMALL).toPandas()
    assert set(after.doc_id) == set(judged[judged.kept].doc_id)
    before, after = kept["line_dedup"]
    want = plain_lines(before)
    assert {i: t for i, t in zip(after.doc_id, after.text)} == want
    assert (after.n_chars == after.text.str.len()).all()
    before, after = kept["simhash_dedup"]
    group = plain_components([plain_print(t) for t in before.text], 4)
    want = {}
    for i, g in zip(before.doc_id, group):
        want[g] = min(i, want.get(g, i))
    assert sorted(after.doc_id) == sorted(want.values())
    before, after = kept["decontamination"]
    dropped = set(before.doc_id) - set(after.doc_id)
    items = {r.item_id: r.text for r in queries.table(spark, SMALL, "benchmark").collect()}
    assert dropped == {d for d, _ in plain_pairs(dict(zip(before.doc_id, before.text)), items)}
    before, after = kept["sentencepiece"]
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {i: len(sp.encode(t or "")) + 2 for i, t in zip(before.doc_id, before.text)}
    assert dict(zip(after.doc_id, after.n_tokens)) == want


def test_every_whole_item_in_a_document_is_found(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    items = queries.table(spark, "/root/testdata/sf0.01", "benchmark")
    texts = {r.doc_id: r.text for r in docs.collect()}
    plain = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t}
    found = {(r.doc_id, r.item_id) for r in templates.decontaminate(docs, items).collect()}
    assert plain <= found and plain


def test_registered_queries_are_listed():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and quality.COLUMNS


def test_run_leaves_only_its_result(spark):
    root = f"{checkpoint_root(spark)}/strata".removeprefix("file:")
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    out = corpus_pipeline.run(spark, SMALL)
    made = set(os.listdir(root)) - before
    assert len(made) == 1 and made.pop().startswith("pipeline-sentencepiece")
    assert out.count() > 0 and out.columns[0] == "doc_id"
