"""Filter audit, vector codes and page texts against plain versions of each."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.llm import filter_audit, page_text, vector_codes
from claimwright.llm.bilstm import Sequence, _gradients, initial, inputs, probabilities
from claimwright.llm.block_labels import Arranger, by_markup
from claimwright.llm.html_blocks import blocks
from claimwright.llm.metric_tree import MetricTree
from claimwright.llm.storage import prepare

SF = "/root/testdata/sf0.001"


# Filter audit

LONG = " ".join(f"w{i}" for i in range(250))


def audit_rows(docs, labels):
    """The audit by walking every document through every order."""
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    counts = defaultdict(Counter)
    parts = sorted({source or "" for _, _, source in docs})
    for doc_id, text, source in docs:
        text, part = text or "", source or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > smallest.get(text, doc_id),
        }
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                cell = counts[part, order, step]
                cell["unique_fails"] += fails[letter] and sum(fails.values()) == 1
                if fails[letter] and gone:
                    cell["redundant"] += 1
                elif fails[letter]:
                    gone = True
                    cell["removed"] += 1
                    cell["good_lost"] += doc_id in good
                    cell["toxic_lost"] += doc_id in toxic
                    counts[part, letter]["shapley"] += 1
                cell["kept"] += not gone
    return sorted(
        (part, order, step, *(counts[part, order, step][c] for c in filter_audit.COUNTS[:-1]),
         counts[part, order[step - 1]]["shapley"])
        for part in parts for order in map("".join, permutations("ABCDE")) for step in range(1, 6)
    )


def test_audit_of_odd_rows(spark):
    prepare(spark)
    docs = [
        (1, LONG, "a"), (2, LONG, "b"), (2, LONG, "b"), (3, LONG, None), (None, LONG, "a"),
        (None, None, "a"), (5, "", ""), (4, None, "b"), (6, "x " * 300, "a"), (7, "A#" * 10, "c"),
        (8, LONG + " ABC DEF GHI JKL MNO PQR STU VWX YZA", "a"), (9, "é ü\x0bo", "a"), (1, "other", "a"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (None, 1, 1), (4, None, 1), (99, 1, 1)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    # Names that the operator uses itself.
    for name in ("part", "cell", "digest", "good", "body", "src", "documents", "quality"):
        table = table.withColumn(name, F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit(1))
    found = filter_audit.filter_audit(table, marks)
    assert found.columns == filter_audit.SCHEMA.names
    assert sorted(tuple(row) for row in found.collect()) == audit_rows(docs, labels)
    assert filter_audit.filter_audit(table.limit(0), marks).count() == 0
    unlabelled = filter_audit.filter_audit(table, marks.limit(0)).collect()
    assert len(unlabelled) == 600 * 4 and not sum(r.good_lost + r.toxic_lost for r in unlabelled)


def test_audit_does_not_gather_a_part_or_a_text(spark):
    prepare(spark)
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("hot").alias("source")
    )
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = filter_audit.filter_audit(docs, marks).where("filter_order = 'EABCD' and step < 3")
    found = {r.step: (r.kept, r.removed, r.redundant) for r in rows.collect()}
    assert found == {1: (1, 19_999, 0), 2: (0, 1, 19_999)}


# Vector codes


def brute_nearest(points, entries):
    gaps = np.square(points[:, None, :] - entries[None]).sum(2)
    return gaps.argmin(1), gaps.min(1)


@pytest.mark.parametrize("rows, width, reach", [(1, 4, 5), (30, 4, 1), (700, 3, 3), (900, 16, 200), (60, 0, 1)])
def test_metric_tree_finds_the_nearest_entries(rows, width, reach):
    rng = np.random.default_rng(rows)
    points = rng.integers(-reach, reach + 1, (rows, width))
    points[::3] = points[0]
    entries = points[rng.integers(0, rows, min(rows, 64))]
    tree = MetricTree.build(points)
    codes, errors = tree.codes(entries)
    want, gaps = brute_nearest(points, entries)
    assert (codes == want).all() and (errors == gaps).all()
    sums, counts = tree.totals(entries)
    for entry in range(len(entries)):
        assert counts[entry] == (want == entry).sum()
        assert (sums[entry] == points[want == entry].sum(0)).all()


def test_anchors_own_whole_balls():
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    points = np.concatenate([c + rng.integers(-20, 21, (200, 2)) for c in centres])
    found = list(MetricTree.build(points).owned(centres))
    assert all(ball >= 0 for _, _, _, ball in found) and len(found) < 12


def codes_of(vectors):
    kept = [v for v in vectors if v[1] is not None and all(x is not None and np.isfinite(x) for x in v[1])]
    width = -(-max(len(v[1]) for v in kept) // 4) * 4
    scaled = [np.floor(np.array(list(v[1]) + [0.0] * (width - len(v[1])), np.float32).astype(float) * 1024) for v in kept]
    parts = np.stack(scaled).astype(int).reshape(len(kept), 4, -1)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(kept[i][1])))
    books = parts[order[:256]].transpose(1, 0, 2).copy()
    for _ in range(4):
        for p in range(4):
            near, _ = brute_nearest(parts[:, p], books[p])
            for entry in set(near):
                of_entry = parts[near == entry, p]
                books[p, entry] = of_entry.sum(0) // len(of_entry)
    found = [brute_nearest(parts[:, p], books[p]) for p in range(4)]
    errors = sum(e for _, e in found)
    by_label = Counter()
    for v, e in zip(kept, errors):
        by_label[v[2]] += int(e)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1))).encode()).hexdigest()
    return Counter(
        (v[0], "".join(f"{c[i]:02x}" for c, _ in found), int(errors[i]), by_label[v[2]], digest)
        for i, v in enumerate(kept)
    )


@pytest.mark.parametrize("rows", [3, 400])
def test_codes_of_odd_vectors(spark, rows):
    prepare(spark)
    rng = np.random.default_rng(rows)
    vectors = [(int(i), [float(x) for x in rng.normal(size=10) / 4], int(i) % 3) for i in rng.permutation(rows)]
    vectors += [(500, vectors[0][1], None), (500, vectors[1][1], None), (500, vectors[1][1], 1)]
    vectors += [(None, vectors[2][1], 2), (600, vectors[0][1][:5], 2), (601, [], 2)]
    vectors += [(700, None, 0), (701, [0.1, None], 0), (702, [float("nan")] * 10, 0), (703, [float("inf")], 0)]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int")
    table = table.repartition(3).withColumn("code", F.lit(1)).withColumn("ids", F.lit(1)).withColumn("error", F.lit(1))
    found = vector_codes.vector_codes(table)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == codes_of(vectors)
    assert vector_codes.vector_codes(table.limit(0)).count() == 0
    assert vector_codes.vector_codes(table.where("vec_id >= 700")).count() == 0
    with pytest.raises(Exception, match="beyond 1024"):
        vector_codes.vector_codes(table.withColumn("embedding", F.array(F.lit(2000.0)))).count()


# Page texts


def test_blocks_of_broken_markup():
    html = (
        "<p>One <b>two &lt;x&gt;&nbsp; y<li>q<ul><li>1<li>2</ul><!-- c <p> --><script>if(a<b)</script>"
        'tail <a href=">">link</a><td>x<div title="unclosed>z</div><p hidden>no</p>'
        '<div style="display:none"><div>no</div>no</div>yes<textarea>no</textarea>'
        "<svg><text>no</text></svg> <br>a < b &amp; &am</nowhere></div><p"
    )
    assert [b.text for b in blocks(html)] == [
        "One two <x> y", "q", "1", "2", "tail link", "x", "z", "yes a < b & &am",
    ]
    assert [b.text for b in blocks("")] == [] and [b.text for b in blocks("<!-- open")] == []
    assert [b.text for b in blocks("<script>open")] == []


def test_very_deep_and_long_pages_are_read():
    deep = "<div>" * 50_000 + "x" + "</p>" * 50_000
    assert [b.text for b in blocks(deep)] == ["x"]
    assert len(list(blocks("<p>a" * 50_000))) == 50_000
    assert len(list(blocks('<p title="' * 20_000))) == 0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(5)
    model = {name: value.astype(np.float64) for name, value in initial(2).items()}

    def sequence(n):
        return Sequence(
            rng.integers(0, 50, 3 * n), rng.random(3 * n), np.arange(0, 3 * n, 3),
            rng.integers(0, 50, 2 * n), np.arange(0, 2 * n, 2), rng.random((n, 8)),
        )

    some = [sequence(4), sequence(7)]
    labels = [rng.integers(0, 2, len(s)).astype(float) for s in some]

    def loss():
        found = probabilities(model, some)
        logs = [np.log(np.where(y == 1, p, 1 - p)) for p, y in zip(found, labels)]
        return -np.concatenate(logs).mean()

    slopes = _gradients(model, some, labels)
    for name, value in model.items():
        flat, slope = value.reshape(-1), slopes[name].reshape(-1)
        for i in np.argsort(-np.abs(slope))[:3]:
            before = flat[i]
            flat[i] = before + 1e-2
            up = loss()
            flat[i] = before - 1e-2
            down = loss()
            flat[i] = before
            assert (up - down) / 2e-2 == pytest.approx(slope[i], rel=0.05, abs=1e-5), name


@pytest.fixture(scope="module")
def pages(spark):
    return prepare(spark).read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def labeller(pages):
    return page_text.fit_labeller(pages)


def test_page_texts_are_the_articles(spark, pages, labeller):
    found = {r.page_id: r for r in page_text.extracted(pages, labeller).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for row in rows:
        want = "\n\n".join(b.text for b in blocks(row.html) if by_markup(b))
        assert found[row.page_id].text == want and found[row.page_id].n_chars == len(want)


def test_unseen_arrangements_are_labelled(spark, labeller):
    other = prepare(spark).read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id >= 50")
    proses = [b.text for r in other.collect() for b in blocks(r.html) if len(b.text.split()) >= 5]
    arranger = Arranger(proses, seed=11)
    made = [page for page in (arranger.page() for _ in range(300)) if page]
    found = probabilities(labeller, [page_text.described([b for b, _ in page]) for page in made])
    right = np.concatenate([(p >= 0.5) == [y for _, y in page] for p, page in zip(found, made)])
    assert right.mean() > 0.99


def test_pages_of_another_template(labeller):
    html = (
        '<body><div id="page"><header><h1>My site</h1><p>A tagline</p></header>'
        '<div class="cookie-consent"><p>We use cookies to make things nice.</p></div>'
        '<ul class="menu"><li><a href="/">Home</a><li><a>News</a></ul><div class="post-content"><h1>Title</h1>'
        "<p>Some prose in a real language,\n which goes on.</p><p>Short.</p><ul><li>first point</li></ul>"
        '<div class="advert">Buy this now.</div><p>Last &amp; least.</p></div>'
        '<div class="comments"><div class="comment"><p>A great article, thanks for it all.</p></div></div>'
        "<aside><p>An other story about things.</p></aside><form><label>Search</label></form>"
        "<footer>Copyright 2020</footer></div>"
    )
    want = "Title\n\nSome prose in a real language, which goes on.\n\nShort.\n\nfirst point\n\nLast & least."
    assert page_text.main_texts([list(blocks(html))], labeller) == [want]


def test_odd_pages(spark, pages, labeller):
    rows = [(1, "u", None), (1, None, ""), (2, "u", "no markup at all"), (None, "u", "<nav>x</nav>"), (3, "u", "<p>" * 9)]
    rows += [(4, "u", "<article>" + "<p>Some text, it goes on.</p>" * 30_000)] * 2
    odd = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    odd = odd.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1)).withColumn("draw", F.lit(1))
    found = page_text.extracted(odd, labeller)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    found = found.collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id == 1] == ["", ""]
    assert [r.n_chars for r in found if r.page_id == 4] == [30_000 * 24 - 2] * 2
    assert page_text.page_texts(odd.limit(0)).count() == 0
    assert [r.text for r in page_text.page_texts(odd.where("html is null")).collect()] == [""]
