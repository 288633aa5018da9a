"""Each operator against the library, a brute-force form or an exact round trip, with awkward rows."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wattloom.llm import byte_bpe, chat_format, common, embedding_dedup, html_extract, license_scan, line_dedup, minhash, packing, quality, queries, token_counts
from wattloom.llm import components as components_module
from wattloom.llm.components import components
from wattloom.llm.template import TemplateError, compile_template

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Columns whose names clash with those that the operators make.
SCHEMA = "doc_id long, text string, lang string, row long, token string, cls long, kept boolean, n long, lines string, `text_now` string"


def texts() -> list[tuple]:
    rng = random.Random(5)
    base = [" ".join(rng.choices([f"w{k}" for k in range(400)], k=60)) for _ in range(30)]
    out = [(k, t) for k, t in enumerate(base)]
    for k in range(30, 60):  # near and exact copies
        words = base[k - 30].split()
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = "edit" + str(rng.random())
        out.append((k, "\n".join(" ".join(words[i : i + 12]) for i in range(0, 60, 12)) if k % 2 else " ".join(words)))
    out += [(60, None), (61, ""), (62, " \t\n \n"), (None, "a row without id but with a text of some words"), (63, base[0]), (63, base[0]), (64, "x" * 5000), (65, "word " * 9000), (66, "İstanbul ǅ ß é <|endoftext|> 'S don't \x1c\x85 　 中文。\n\n\ra,b. A.")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 1, "t", 2, True, 3, "l", "n") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_row(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_html():
    page = """<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body><header>Site</header><nav><ul><li><a href=1>Menu</a></ul></nav>
      <div class="cookie-notice"><p>We use cookies, and more cookies, to make you accept cookies, always.</p></div>
      <article><h1>Head &amp; line</h1><p>First, a paragraph<br>of&nbsp;text, with   commas.<p>Second <b>bold <i>it</b> one.</p><form><input><p>Sign up, now</p></form><aside>Side</aside><div class=ad>Buy</div></article>
      <section id="comments"><article class="comment"><p>I liked this, really, it was the best, ever, and long enough too.</p></article></section><footer>&copy; me</footer></body>"""
    assert html_extract.extract(page) == "Head & line\n\nFirst, a paragraph of text, with commas.\n\nSecond bold it one."
    plain = "<body><div id=menu><a href=x>one</a> <a href=y>two</a></div><div><p>A long paragraph, with commas, in a plain div, that counts.</p><p>Another one, as good.</p></div>"
    assert html_extract.extract(plain) == "A long paragraph, with commas, in a plain div, that counts.\n\nAnother one, as good."
    for odd in (None, "", "<", "<<<>>>", "<p", "</p></p>", "<!-- open", "<script>x", "a" * 100_000, "<div>" * 3000 + "x"):
        assert isinstance(html_extract.extract(odd), str)


def test_html_keeps_figures_and_siblings():
    page = "<article><p>Before it.</p><figure><img src=x><pre>a = 1</pre><table><tr><td>cell</td></tr></table><figcaption>What it shows.</figcaption></figure><p>After it.</p></article>"
    assert html_extract.extract(page) == "Before it.\n\na = 1\n\ncell\n\nWhat it shows.\n\nAfter it."
    first, second, third = "A long paragraph, with commas, in one part, that counts. " * 8, "A single paragraph without any of those marks but with words " * 2, "Short, but with a comma."
    page = f"<body><div><p>{first}</p><p>{first}</p></div><section><p>{second}</p></section><div><p>{third}</p></div><ul><li><a href=x>{second}</a></ul><div>Tiny</div></body>"
    assert html_extract.extract(page).split("\n\n") == [first.strip(), first.strip(), second.strip(), third]


def test_html_class_words_are_weights():
    body = "<p>A long paragraph, with commas, that counts as the text of it.</p><p>Another one, as good as that, for the score.</p>"
    want = "A long paragraph, with commas, that counts as the text of it.\n\nAnother one, as good as that, for the score."
    for names in ("page no-sidebar", "content has-comments", "layout-with-sidebar", "promo", "post-share"):
        assert html_extract.extract(f'<body><div class="{names}">{body}</div></body>') == want, names
    assert html_extract.extract(f'<article>{body}</article><div class="sidebar"><p>See also, if you like, the other page.</p></div>') == want
    talk = "<p>I liked this, really, it was the best, ever, and long enough too, as comments go.</p>" * 9
    assert html_extract.extract(f'<article>{body}</article><section id="comments">{talk}</section>') == want
    assert html_extract.extract(f'<div class="wrap"><div>{body}</div><div class="comment-list">{talk}</div></div>') == want
    assert html_extract.extract('<body><div class="ad">Buy</div></body>') == ""


def test_html_container_is_not_left_for_its_surroundings():
    body = "<p>A long paragraph, with commas, that counts as the text of it.</p><p>Another one, as good as that, for the score.</p>"
    want = "A long paragraph, with commas, that counts as the text of it.\n\nAnother one, as good as that, for the score."
    around = '<main><header>Site name, and claim</header><article>{}</article><div class="teasers"><p>Read this next, it is good.</p><a href=x>More</a></div></main>'
    assert html_extract.extract(around.format(body)) == want
    menu = "<div><a href=a>One page</a> <a href=b>Another page</a> <a href=c>Third</a></div>"
    assert html_extract.extract(f"<article>{menu}{body}{menu}</article>") == want
    assert html_extract.extract(f"<article><header><h1>Title</h1><p>By me, today</p></header>{body}</article>") == f"Title\n\n{want}"
    assert html_extract.extract(f"<article><div>{body}</div><p>End.</p></article>") == f"{want}\n\nEnd."
    assert html_extract.extract("<article><p>a &<b>amp;</b> b &amp;lt; c</p></article>") == "a &amp; b &lt; c"


@pytest.mark.parametrize("text", ["<a ", "<a '", "<a '>' ", "<!-- ", "<b>", "<dd><b>", "<li><b>", "<p><i>", "<script ", "<a \"<", "</b>", "&am", "<tr><td>"])
def test_html_broken_markup_takes_linear_time(text):
    import time

    began = time.process_time()
    assert isinstance(html_extract.extract(text * (1_500_000 // len(text)) + "x"), str)
    assert time.process_time() - began < 30


def test_html_pages(spark):
    rows = [(1, "u", "<article><p>Text one.</p></article>", "t"), (None, None, None, "t"), (1, "u", "<article><p>Text one.</p></article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert by_row(html_extract.extract_pages(df), "page_id", "text", "n_chars") == [(1, "Text one.", 9), (1, "Text one.", 9), (None, "", 0)]
    assert html_extract.extract_pages(df.limit(0)).count() == 0
    clashing = df.withColumn("points", F.lit(1)).withColumn("n_chars", F.lit("x")).withColumn("tag", F.lit(2))
    assert by_row(html_extract.extract_pages(clashing), "page_id", "n_chars") == [(1, 9), (1, 9), (None, 0)]
    got = queries.op1_html_extraction(spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert got.where("text like '%©%' or text like '%</%' or text = ''").count() == 0


def test_licenses(spark, docs, empty):
    rows = [(1, "Under the MIT License, and again: under the mit license. CC BY-NC 4.0"), (2, "This work is licensed under the GNU General Public License, version 3."), (3, "Permission is hereby granted, without any charge, to any person obtaining a copy of this software and the associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"), (4, "the mit license under"), (5, None)]
    got = {r["doc_id"]: r.asDict() for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"], got[1]["n_words"]) == (3, 0, 10, "cc-by-nc,mit", 15)
    assert got[2]["labels"] == "gpl-3" and got[2]["base_labels"] == "" and got[2]["score"] == 1.0
    assert got[3]["labels"] == "mit" and 0.6 <= got[3]["score"] < 1
    assert got[4]["labels"] == "" and got[4]["score"] == 0 and got[5]["n_words"] == 0
    phrases = {p: license_scan.template_words(p) for p in license_scan.PHRASES}
    for r in queries.op2_license_scan(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        words = re.findall(license_scan.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        places = [i for q in phrases.values() for i in range(len(words)) if words[i : i + len(q)] == q]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(places, default=None), max(places, default=None))
    assert license_scan.scan_licenses(docs).count() == docs.count() and license_scan.scan_licenses(empty).count() == 0


def brute_lines(rows):
    order = sorted({(i if i is not None else 1 << 62, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    earlier, removed = [], defaultdict(list)
    for i, t in order:
        for p, line in enumerate(t.split("\n")):
            s = set(re.split(r"[ \t\x0b\f\r]+", line.strip(" \t\x0b\f\r"))) - {""}
            if not s:
                continue
            if any(len(s & o) * 100 >= 80 * len(s | o) for o in earlier):
                removed[i].append(p)
            earlier.append(s)
    return removed


def test_lines(spark, docs, empty):
    removed = brute_lines(texts())
    for r in line_dedup.line_report(docs).collect():
        assert r["removed"] == removed[r["doc_id"] if r["doc_id"] is not None else 1 << 62], r["doc_id"]
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[0] == texts()[0][1] and kept[60] is None and kept[61] == "" and 63 not in kept
    assert line_dedup.line_report(empty).count() == 0 and line_dedup.dedup_lines(empty).count() == 0


def short_texts():
    rng = random.Random(8)
    held = ["Les.\nA line of six words here\nLes.\n\nOne two", "Les.\ntwo  One\none two\none two three four", "four three two one five\n \t\nthree one two\none two three\nLes. \t", "a b a b a\nb a\nLes.", "Les.", "b b b b b b\nb\nb\r"]
    held += ["\n".join(" ".join(rng.choices("abcdef", k=rng.randrange(8))) for _ in range(5)) for _ in range(20)]
    return list(enumerate(held))


def test_short_lines(spark):
    """Lines of one to four words are held against earlier ones like any others."""
    rows, earlier, removed, kept = short_texts(), [], {}, {}
    for i, t in rows:
        gone = []
        for p, line in enumerate(t.split("\n")):
            s = set(line.split())
            if s and any(len(s & o) * 100 >= 80 * len(s | o) for o in earlier):
                gone.append(p)
            earlier += [s] if s else []
        removed[i] = gone
        rest = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
        if rest.split() or not gone:
            kept[i] = rest
    assert removed[0] == [2] and removed[2][0] == 0 and 4 not in kept
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.line_report(df).collect()} == removed
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()} == kept


def test_white_space_parts_words(spark):
    """Lines that only differ in white space have one set of words; those that a word differs in too few words stay."""
    line = "one two three four five six"
    rows = [(1, line), (2, "one\ttwo  three\x0bfour\ffive six\r"), (3, "\t\x0b \f\r\n \t" + line + " seven eight"), (4, "one two\tthree four five seven"), (5, None)]
    out = {r["doc_id"]: (r["n_lines"], r["removed"]) for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (1, []), 2: (1, [0]), 3: (2, []), 4: (1, []), 5: (0, [])}


def test_posted_tokens_are_plain_longs(spark, docs):
    """Tokens are sorted and postings joined without tests for nulls; a line's second long of parity bits is made for long lines only."""
    classes = line_dedup.with_prefix(line_dedup.distinct_lines(docs), line_dedup.rarity(docs), 80)
    assert not classes.schema["own"].dataType["prefix"].dataType.containsNull
    read = spark.createDataFrame(classes.limit(5).collect(), classes.schema)
    assert [f.name for f in line_dedup.postings(read).schema if f.nullable] == []
    rows = [(1, " ".join(f"w{i}" for i in range(k, k + n))) for k, n in ((0, 3), (10, 64), (100, 65), (200, 300))]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    own = [r["own"] for r in line_dedup.with_prefix(line_dedup.distinct_lines(made), line_dedup.rarity(made), 80).collect()]
    assert sorted((x["n"], x["b1"] != 0) for x in own) == [(3, False), (64, False), (65, True), (300, True)]


def test_similar_lines_about_the_long_bound(spark):
    """Lines of about as many words as those with a second long of parity bits, similar ones on both sides of the bound."""
    rng, rows = random.Random(5), []
    for k in range(40):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(45, 95))]
        rows.append((2 * k, " ".join(words)))
        gone = rng.sample(range(len(words)), rng.randrange(len(words) // 3))
        rows.append((2 * k + 1, " ".join(w for i, w in enumerate(words) if i not in gone) + " x" * (k % 2)))
    removed = brute_lines(rows)
    assert 10 < len(removed) < 40
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["removed"] for r in got if r["removed"]} == removed


def test_line_report_moves_no_text(docs):
    """The report's last join takes places of lines, not texts or lines."""
    plan = line_dedup.line_report(docs)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join LeftOuter") :].split("\n")
    assert "lines#" not in join[1].split("AS worded")[1] and "text#" not in join[1].split("AS worded")[1]


def test_scratch_files_are_few(spark, docs, monkeypatch):
    """A table of few rows is few files, however many partitions made it, and a file forks no more than two processes."""
    made = []

    def counted(df, *files):
        back = common.saved(df, *files)
        folder = back._wattloom_path.removeprefix("file:")
        made.append(len([x for x in os.listdir(folder) if x.startswith("part-")]))
        assert not [x for x in os.listdir(folder) if x.endswith(".crc")]
        return back

    for module in (line_dedup, minhash, components_module):
        monkeypatch.setattr(module, "saved", counted)
    with common.setting(spark, "spark.sql.shuffle.partitions", "23"), common.setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert minhash.without_near_duplicates(docs).count() and line_dedup.dedup_lines(docs).count()
    # Those whose rows aren't known beforehand: lines, links by stars and by tiles, sets of shingles, edges.
    assert sum(n > 3 for n in made) <= 6


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    want = sorted(((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in texts()), key=str)
    assert by_row(token_counts.count_tokens(docs, WORDS), "doc_id", "n_bytes", "n_tokens") == want
    assert by_row(token_counts.count_tokens(docs, WORDS, frequent=5), "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.count_tokens(empty, WORDS).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    m = np.concatenate([base, base[:20] + 0.1 * rng.normal(size=(20, 16)), base[:3]])
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(m)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0] * 8), (None, [1.0] * 16)]
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    f = m.astype(np.float32).astype(float)
    n = np.linalg.norm(f, axis=1)
    near = (f @ f.T) / (n[:, None] * n[None]) >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(m))
    for _ in m:
        label = np.minimum(label, np.where(near, label[None], len(m)).min(axis=1))
    assert near.sum() > 10
    for k in range(len(m)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (near[k].sum(), label[k], label[k] == k)
    for k in (900, 901, 902, 903, 904, 905):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert embedding_dedup.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embeddings_of_repeated_ids(spark):
    """An id with several vectors is one node; repeated rows, huge and tiny vectors, clashing columns."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(12, 8))
    rows = [(int(k % 30), (base[rng.integers(12)] + 0.12 * rng.normal(size=8)) * 10.0 ** rng.integers(-200, 200)) for k in range(90)]
    rows += [(k, v) for k, v in rows[:20]] + [(500 + k, rows[k][1]) for k in range(5)] + [(0, rows[1][1])]
    df = spark.createDataFrame([(k, [float(x) for x in v], 1, "c", True) for k, v in rows], "vec_id long, embedding array<double>, cls long, root string, told boolean")
    near, m = defaultdict(set), [(k, v / np.abs(v).max()) for k, v in rows]
    m = [(k, v / np.linalg.norm(v)) for k, v in m]
    for k, v in m:
        for j, w in m:
            if k != j and v @ w >= 0.95:
                near[k].add(j)
    label = {k: k for k, _ in rows}
    for _ in label:
        label = {k: min([label[k], *(label[j] for j in near[k])]) for k in label}
    got = embedding_dedup.embedding_links(df).collect()
    assert len(got) == len(rows) and len(set(label.values())) < len(label)
    for r in got:
        k = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(near[k]), label[k], label[k] == k)


def test_int8_products_are_exact():
    rng = np.random.default_rng(4)
    for width in (3, 64, 1024, 1500, 3000):
        a = rng.choice([-127, 127, 126, 3], size=(5, width)).astype(np.int8)
        b = np.concatenate([a[:2], rng.integers(-127, 128, size=(5, width))]).astype(np.int8)
        assert (embedding_dedup.products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


@pytest.mark.parametrize("width", [64, 256, 1000])
def test_embedding_slack(width, monkeypatch):
    """The slack of the tile product is at least the error bound of a float32 sum of that width, and tile() takes it."""
    assert embedding_dedup.slack(width) >= width * 2.0**-24 * 1.3 + 3 * 2.0**-24
    least = []
    monkeypatch.setattr(embedding_dedup, "slack", lambda n: least.append(n) or 0.5)
    embedding_dedup.tile(np.arange(2), np.ones(2, np.int64), np.eye(2, width) + 1, 2, 0.95)
    assert least == [width]


def test_byte_bpe(docs, empty):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, x in texts():
        ids = np.array(t.encode_ordinary(x or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()))
    assert by_row(byte_bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    assert byte_bpe.encode_documents(docs.where("doc_id = 66"), RANKS, public_tokenizers.PATTERN).first()["decoded"] == texts()[-1][1].encode()
    assert byte_bpe.encode_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_template():
    run = lambda source, **scope: "".join(t for t, _ in compile_template(source)(scope))
    assert run("a{{ 1 + 2 }}{{ 'x' ~ y }}", y=4) == "a3x4"
    assert run("{% for m in ms %}{{ loop.index }}{{ m.a }}{% if not loop.last %},{% endif %}{% endfor %}", ms=[{"a": 1}, {"a": 2}]) == "11,22"
    assert run("{% if x == 1 %}one{% elif x in [] %}{% else %}other{% endif %}".replace(" in []", " == 2"), x=3) == "other"
    assert run("{{ x.__class__ }}{{ x['y'].z }}|{{ 'b' if x else 'c' }}", x={"y": {"z": 5}}) == "5|b"
    assert run("  {%- set q = 'n' | upper -%}  {{ q }}") == "N"
    for bad in ("{% if x %}", "{% endfor %}", "{{ 1 + }}", "{{ x | nope }}", "{{ f() }}", "{% while x %}"):
        with pytest.raises(TemplateError):
            run(bad)


def test_chat(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "", None, "a\nb", "<", "|", "<|im_end|>\n", "%0A%25"]
    rows = [(1, k, "assistant" if k % 2 else "user", x) for k, x in enumerate(nasty)] + [(2, None, None, "x"), (2, 0, "ro\nle<|im_end|>%", "y"), (None, 0, "assistant", "z"), (3, 1, "user", "b"), (3, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat_format.format_conversations(df)
    got = {r["conv_id"]: r.asDict() for r in chat_format.conversation_digests(pieces).collect()}
    own = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        own[c].append((r or "", x or ""))
    for c, turns in own.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[1]["formatted_chars"] == sum(len(r["text"]) for r in pieces.where("conv_id = 1").collect())
    clashing = df.withColumn("place", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("n_turns", F.lit(2))
    assert {r["conv_id"]: r.asDict() for r in chat_format.conversation_digests(chat_format.format_conversations(clashing)).collect()} == got
    assert chat_format.conversation_digests(chat_format.format_conversations(df.limit(0))).count() == 0


def test_chat_template_sees_the_conversation(spark):
    template = "[{% for m in messages %}{{ loop.index }}{% if loop.first %}f{% endif %}{% generation %}{{ m.text }}{% endgeneration %}{% if not loop.last %},{% endif %}{% endfor %}]"
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "user", "c"), (2, 0, "user", "d")], "conv_id long, turn long, role string, text string")
    got = by_row(chat_format.format_conversations(df, template), "conv_id", "place", "text", "spans")
    assert [(*r[:3], [tuple(x) for x in r[3]]) for r in got] == [(1, 0, "[1fa,", [(3, 4)]), (1, 1, "2b,", [(1, 2)]), (1, 2, "3c]", [(1, 2)]), (2, 0, "[1fd]", [(3, 4)])]


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(docs, WORDS, block=20_000).collect()
    places, tokens = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        tokens[r["doc_id"]].append(r)
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at and n > 0
            at += n
        assert at == 4096 or at & (at - 1) == 0 and at < 4096
    for i, x in texts():
        if i == 63:
            continue
        ids, at = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(tokens[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + r["length"]].tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_packing_balances():
    lengths = [random.Random(1).randrange(1, 9000) for _ in range(400)]
    pieces = packing.pack(lengths)
    cost, size = defaultdict(float), defaultdict(int)
    for d, _, n, s, _ in pieces:
        cost[s] += n + n * n / 8192
        size[s] += n
    assert sum(size.values()) == sum(lengths)
    whole = [s for s in size if size[s] == 4096 and sum(1 for p in pieces if p[3] == s) > 1]
    assert max(cost[s] for s in whole) < 1.6 * min(cost[s] for s in whole)


def test_line_families(spark):
    """Near copies of one line, long lines, odd white space: the same lines go as by brute force."""
    rng = random.Random(12)
    base, rows = [f"f{k}" for k in range(40)], []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(40)] = f"x{rng.randrange(30)}"
        rows.append((k, " ".join(words) + "\n" + "  ".join(words[:20]) + "\n" + "\t".join(words[20:]) + " \n" + " " + " ".join(reversed(words))))
    rows += [(100 + k, " ".join(rng.choices([f"w{j}" for j in range(900)], k=400))) for k in range(12)]
    removed = brute_lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in line_dedup.line_report(df).collect():
        assert r["removed"] == removed[r["doc_id"]], r["doc_id"]
    assert sum(map(len, removed.values())) > 60


def brute_near(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    ids = sorted(i for i in sets if i is not None)
    label = {i: i for i in ids}
    for _ in range(6):
        for a in ids:
            for b in ids:
                if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    return {i: len(s) for i, s in sets.items()}, label


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, empty, size):
    n, label = brute_near(texts(), size)
    rows = minhash.near_duplicates(docs, size=size).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = (n[r["doc_id"]], label.get(r["doc_id"]), r["doc_id"] is None or label[r["doc_id"]] == r["doc_id"])
        assert (r["n_shingles"], r["component_id"], r["kept"]) == want
    assert len({x for x in label.values()}) < len(label) - 10
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """An id with several texts is one document to the report; the filter goes by texts and loses none."""
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choices([f"w{k}" for k in range(300)], k=50)) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b + " more"), (4, c), (5, None), (5, c), (None, a), (6, ""), (6, "")]
    df = spark.createDataFrame([(i, t, 1, "s", True, 2) for i, t in rows], "doc_id long, text string, key long, sig string, kept boolean, cid long")
    got = by_row(minhash.near_duplicates(df), "doc_id", "component_id", "kept")
    want = [(1, 1, True), (2, 1, False), (2, 1, False), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (5, 5, True), (6, 6, True), (6, 6, True), (None, None, True)]
    assert got == sorted(want, key=str)
    left = minhash.without_near_duplicates(df)
    assert left.columns == df.columns
    assert by_row(left, "doc_id", "text") == sorted([(1, a), (2, b), (2, b), (4, c), (5, None), (None, a), (6, ""), (6, "")], key=str)
    assert minhash.without_near_duplicates(df.limit(0)).count() == 0


def test_tiles_find_what_stars_miss():
    """Links between components in one list, found in tiles of either kind."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64)) for _ in range(2)]
    sets += [np.unique(np.concatenate([sets[0][:95], sets[1][:5]]))]
    rows = [(k, k, minhash.signature(s), frozenset(), s) for k, s in enumerate(sets)]
    assert minhash.tile_links(rows, 3, 14, 80) == [(0, 2)] == minhash.tile_links(rows, 1, 14, 80)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    got = {r["u"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(words, window=8):
    runs = defaultdict(list)
    for k in range(len(words) - window + 1):
        runs[tuple(words[k : k + window])].append(k)
    return len({p for at in runs.values() if len(at) > 1 for k in at for p in range(k, k + window)})


def test_quality(spark, docs, empty):
    rng = random.Random(4)
    for n in (0, 5, 8, 40, 300):
        words = [rng.choice([b"a", b"b"]) for _ in range(n)]
        assert quality.repeated_words(words) == brute_repeats(words)
    labels, all_docs = spark.read.parquet(f"{SMALL}/labels.parquet"), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    crf = quality.fit(all_docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), most=200)
    held = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    report = {r["doc_id"]: r for r in quality.quality_report(all_docs, crf).collect()}
    right = [report[i]["kept"] == bool(y) for i, y in held.items() if not report[i]["base_failed"]]
    assert sum(right) / len(right) > 0.97
    rows = quality.quality_report(docs, crf).collect()
    for i, t in texts():
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), brute_repeats(words))
        assert want in [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows if r["doc_id"] == i]
    kept = quality.quality_filter(docs, quality.LineCrf())
    assert kept.columns == docs.columns and kept.count() == sum(not r["base_failed"] for r in rows)
    assert quality.quality_report(empty, crf).count() == 0
    assert quality.fit(docs, labels.limit(0)).emit == [0.0] * quality.N_FEATURES


def test_quality_of_documents_held_out(spark):
    """Fitted on half of the labelled documents, right on the other half."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    half = labels.select("doc_id").distinct().count() // 2
    fitted = {r["doc_id"] for r in labels.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(half).collect()}
    held = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] not in fitted}
    odd = labels.select("doc_id", "quality").unionByName(spark.createDataFrame([(k, 7) for k in held], "doc_id long, quality int").withColumn("quality", F.col("quality").cast(labels.schema["quality"].dataType)))
    report = {r["doc_id"]: r for r in quality.quality_report(docs, quality.fit(docs, odd, most=half)).collect()}
    right = [report[i]["kept"] == bool(y) for i, y in held.items() if not report[i]["base_failed"]]
    assert len(right) > 40 and sum(right) / len(right) > 0.95


def test_quality_is_fitted_on_all_lines(spark, monkeypatch):
    """Lines after the 120th of a labelled document reach the training."""
    rows = [(k, "\n".join(f"Line {n} of a text." for n in range(300 + k))) for k in range(4)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda examples: seen.extend((len(f), y) for f, y in examples))
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen == [(300, 1), (301, 0), (302, 1), (303, 0)]


def test_viterbi_finds_the_best_sequence():
    rng = random.Random(6)
    crf = quality.LineCrf([rng.uniform(-1, 1) for _ in range(quality.N_FEATURES)], [[0.4, -0.3], [-0.2, 0.5]])
    features = [[rng.randrange(quality.N_FEATURES) for _ in range(3)] for _ in range(8)]
    value = lambda labels: sum(y * sum(crf.emit[i] for i in f) for y, f in zip(labels, features)) + sum(crf.move[a][b] for a, b in zip(labels, labels[1:]))
    best = max(value([k >> i & 1 for i in range(8)]) for k in range(256))
    assert value(crf.viterbi(features)) == pytest.approx(best)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    shown = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, shown, SMALL)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        before = {r["doc_id"]: r["text"] for r in shown.collect()}
        now = {r["doc_id"]: r["text"] for r in after.collect()}
        assert set(now) <= set(before)
        if name == "line dedup":
            removed = brute_lines(before.items())
            for i, t in before.items():
                rest = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in set(removed[i]))
                assert now.get(i, "") == rest if i in now else not rest.split()
        if name == "MinHash near-dedup":
            n, label = brute_near(before.items(), 5)
            assert set(now) == {i for i in before if label[i] == i} and after.count() == len(now)
        shown = after
    packed = corpus_pipeline.STAGES[3][1](spark, shown, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in shown.collect()}


def test_pipeline_takes_awkward_documents(spark, docs, empty):
    """Nulls, empty and long texts, repeated rows and clashing columns go through all stages, as does an empty table."""
    import corpus_pipeline

    rng = random.Random(21)
    held = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, held, SMALL)
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
            assert stage(spark, empty, SMALL).count() == 0
            held = spark.createDataFrame(after.collect(), docs.schema)
        if name == "quality rules":
            more = [(None, " ".join(rng.choices([f"v{k}" for k in range(500)], k=30))), (70, None), (71, ""), (71, "")]
            held = held.unionByName(spark.createDataFrame([(i, t, None, None, None, None, None, None, None, None) for i, t in more], docs.schema))
    kept = {(r["doc_id"], r["text"]) for r in held.collect()}
    assert {(70, None), (71, ""), more[0]} <= kept and after.where("doc_id is null").count() > 0 and empty.count() == 0
