import re
from collections import Counter

import corpus_pipeline as cp
from quarry.llm import toxicity
from quarry.llm.common import materialised
from quarry.plans.tables import table
from tests.compare import duck
from tests.conftest import SF_CHECK

from . import awkward
from .test_exact_dedup import brute as exact
from .test_pieces import digest
from .test_simhash import brute_components, brute_fp


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = table(spark, SF_CHECK, "documents")
    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, table(spark, SF_CHECK, "labels")).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    want = Counter(i for i in rows if not predicted[i])
    kept = materialised(cp.drop_toxic(spark, docs, SF_CHECK), "t1")
    assert Counter(r.doc_id for r in kept.collect()) == want and len(want) < len(rows) and kept.columns == docs.columns

    unique = materialised(cp.drop_copies(spark, kept, SF_CHECK), "t2")
    want = Counter(r[0] for r in exact([(i, rows[i].text) for i in want]) if r[3])
    assert Counter(r.doc_id for r in unique.collect()) == want and unique.columns == docs.columns

    single = materialised(cp.drop_near_copies(spark, unique, SF_CHECK), "t3")
    want = Counter(r[0] for r in brute_components([(i, brute_fp(rows[i].text)) for i in want]) if r[0] == r[2])
    assert Counter(r.doc_id for r in single.collect()) == want and single.columns == docs.columns

    mixed = materialised(cp.mix_sources(spark, single, SF_CHECK), "t4")
    from quarry.llm.queries import ORACLES
    con = duck(SF_CHECK)
    con.register("kept_ids", __import__("pandas").DataFrame({"doc_id": list(want)}))
    taken = con.execute(ORACLES["op6_pareto_mix"].replace("FROM documents)", "FROM documents SEMI JOIN kept_ids USING (doc_id))")).fetchall()
    want = Counter({i: t // size for i, size, _, _, t in taken if t})
    assert Counter(r.doc_id for r in mixed.collect()) == want and mixed.columns == docs.columns

    out = cp.to_pieces(spark, mixed, SF_CHECK)
    assert Counter(map(tuple, out.collect())) == Counter({digest(i, rows[i].text): n for i, n in want.items()})


def test_awkward_documents(spark, tmp_path):
    awkward.frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = cp.run(spark, str(tmp_path)).collect()
    # every stage by brute force: nothing is called toxic (too few labels), one row of each equal text, one of each group, then the mix
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    by_text, single = {}, {}
    for r in sorted(awkward.rows(), key=lambda r: (r[0] is None, r[0] or 0)):
        by_text.setdefault(norm(r[1]), r)
    named = {i: r for i, r in enumerate(by_text.values())}
    for i, _, root in sorted(brute_components([(i, brute_fp(r[1])) for i, r in named.items()])):
        single.setdefault(root, named[i])
    ids = Counter(r.doc_id for r in out)
    assert set(ids) <= {r[0] for r in single.values()} and max(ids.values()) <= 2
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", single_text or "")) * ids[i] for i, single_text in ((r[0], r[1]) for r in single.values()))
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in single.values())
    assert total <= words <= 2 * total
    assert {tuple(r) for r in out} == {digest(r[0], r[1]) for r in single.values() if ids[r[0]]}
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, awkward.empty(spark), str(tmp_path)).columns == awkward.empty(spark).columns, name
