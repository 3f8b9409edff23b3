import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlake.llm import canon, leaks, lookalikes, markup, overlap, pages, split, survivors, tokens


# 1: pages


def report(markdown, doc="pub_2024-x", origin="pdf", description=None):
    return (doc, origin, markdown, description, "extra")


REPORT = "doc_id string, origin string, markdown string, description string, text string"


def test_pages_find_and_repair(spark):
    body = "the quick value of every batch is checked before the token moves and the reserve stays open. " * 12
    page = "# **Big Vault**\n\nPrepared by Pub\n\nthe value of every ba-\n\n2\n{3}------------------------------------------------\n\nBig Vault Security Review\n\ntch is chccked before a cross-\nchain token moves.\n\n```\nva-\n12\n```\n\n| a- |\n"
    clean = "# T\n\n" + body + "The cross-chain token is checked.\n"
    rows = [report(page)] + [report(page.replace("Big Vault", f"Big {n}"), f"pub_{n}") for n in ("Pool", "Lock", "Gate")] + [report(clean, f"n_{k}", "native") for k in range(4)] + [report(None, "pub_null"), report("", "pub_empty"), report(None, None)]
    df = spark.createDataFrame(rows, REPORT)
    _, found = pages.scan_findings(df)
    mine = {(r.line_no, r.kind) for r in found.where("doc_id = 'pub_2024-x'").collect()}
    assert mine == {(5, "hyphen"), (7, "furniture"), (8, "furniture"), (10, "furniture"), (12, "misread"), (12, "compound")}
    text = pages.repaired(df).where("doc_id = 'pub_2024-x'").first().text
    assert "the value of every batch is checked before a cross-chain token moves." in text
    assert "```\nva-\n12\n```" in text and "Security Review" not in text
    assert pages.repaired(df.where("false")).count() == 0


def test_every_recurring_head_counts(spark):
    rng = random.Random(3)
    heads = ["".join(rng.choices("dfhjkmpuvwxyz", k=14)) for _ in range(200)]
    mark, body = "{3}------------------------------------------------", "the reserve stays open while the token moves"
    page = lambda head, n: "# Vault\n\n" + f"{body}\n\n{mark}\n\n{head}\n\n" * n + body
    rows = [report(page(f"Vault {h}", 4), f"pub_{k}") for k, h in enumerate(heads)]
    rows += [report(page(f"{h} for Vault", 1), f"rare_{k}") for k, h in enumerate(("Quartz paper", "Qu4rtz paper", "Quartz p4per"))]
    texts = pages.scanned_texts(spark.createDataFrame(rows, REPORT))
    templates = pages.head_templates(texts)
    assert {x for x in templates if x.startswith("<T>")} == {f"<T> {h}" for h in heads} and len(templates) == 201
    _, found = pages.scan_findings(spark.createDataFrame(rows, REPORT))
    assert found.where("kind = 'furniture' and doc_id like 'rare%' and line_no = 7").count() == 3


def test_anagram_hash_finds_only_confusions(spark):
    words = spark.createDataFrame([("value", 90, 90), ("va1ue", 1, 0), ("vaule", 1, 0), ("vale", 1, 0), ("furnish", 50, 50), ("fumish", 2, 0), ("clear", 40, 40), ("dear", 30, 30)], "word string, n_scanned long, n_clean long")
    assert {(r.word, r.meant) for r in pages.corrections(words).collect()} == {("va1ue", "value"), ("fumish", "furnish")}


def test_any_sign_of_a_word_can_be_hashed(spark):
    """A line that ends at U+2010 with no word behind it leaves that sign in a word."""
    words = [("con\u2010", 1, 0), ("owner\u2019s", 40, 40), ("0wner\u2019s", 2, 0), ("\U0001d41a" * 9000, 1, 0), ("\u65e5\u672c\u8a9ela1", 1, 0), ("\u65e5\u672c\u8a9elal", 9, 9)]
    df = spark.createDataFrame(words, "word string, n_scanned long, n_clean long")
    assert {(r.word, r.meant) for r in pages.corrections(df).collect()} == {("0wner\u2019s", "owner\u2019s"), ("\u65e5\u672c\u8a9ela1", "\u65e5\u672c\u8a9elal")}
    page = "# Vault\n\nthe value of every con\u2010\n\n(3.1)\n\nthe token moves\n"
    _, found = pages.scan_findings(spark.createDataFrame([report(page)], REPORT))
    assert found.where("kind = 'hyphen'").count() == 0
    assert pages.repair("see \\emph{c1ose}", [(1, "misread", "\\emph{c1ose", "\\emph{close", None)]) == "see \\emph{close}"


# 2: values


def test_values(spark):
    entries = spark.createDataFrame([(1, "s", "Critical", "m"), (2, "s", "High", "m"), (3, "s", "Low", "m"), (21, "t", "Access Control", "m"), (22, "t", "Denial of Service", "m")], "canon_id int, field_name string, canon_value string, value string")
    typed = {
        "s": {"Critical": 1, "crit": 1, "C": 1, " hihg ": 2, "**Low**": 3, "5. Low": 3, "Severity: low": 3, "lw": 3, "": 0, "?": 0, "lower third": 0, "Highlight": 0, "x" * 5000: 0},
        "t": {"Control, access": 21, "access-ctl": 21, "AccessControl": 21, "DoS": 22, "denial_of_svc": 22, "front desk": 0},
    }
    rows = [(f, v, 1) for f, vs in typed.items() for v in vs] * 2 + [("s", None, 1), (None, "Low", 1)]
    got = canon.match_values(spark.createDataFrame(rows, "field_name string, value string, canon_id int"), entries)
    assert {(r.field_name, r.value): r.canon_id for r in got.collect()} == {(f, v): c for f, vs in typed.items() for v, c in vs.items()}
    assert canon.match_values(spark.createDataFrame([], "field_name string, value string"), entries).count() == 0


# 3: pieces


@pytest.mark.parametrize("seed", range(4))
def test_pieces_restore(seed):
    rng = random.Random(seed)
    parts = ["# Head\n", "word ", "A sentence. ", "\n\n", "```\ncode\n\nmore\n```\n", "é" * 30, "x" * 400, "日本。", "\r\n", "👨‍👩‍👧"]
    text = "".join(rng.choice(parts) for _ in range(300))
    pieces = split.split_text(text, 500, 60)
    assert pieces[0][5] + "".join(p[5][p[3] :] for p in pieces[1:]) == text
    assert all(len(p[5]) <= 500 for p in pieces) and all(b[5][:60] == a[5][-60:] for a, b in zip(pieces, pieces[1:]))


def test_pieces_prefer_boundaries_and_tables(spark):
    text = "# A\n" + "a " * 100 + "\n# B\n" + "b " * 100
    assert [p[4] for p in split.split_text(text, 300, 20)] == ["section", "end"]
    df = spark.createDataFrame([("k", text), ("n", None), ("e", "")], "piece string, text string")
    got = split.split_items(df.withColumnRenamed("piece", "id"), "text", 300, 20, keys=("id",))
    assert {(r.id, r.piece_no) for r in got.collect()} == {("k", 1), ("k", 2), ("e", 1)}
    assert {r.id: r.text for r in split.restore(got, ("id",)).collect()} == {"k": text, "e": ""}


# 4: markup


def test_markup():
    clean = markup.Cleaner()
    cases = {
        "a <b>x</b> &amp; y": ("a x & y", ["html"]),
        "code `<b>` and ``a ` b`` stay": ("code `<b>` and ``a ` b`` stay", []),
        "```\n<p> [[x]] \\textbf{y}\n```": ("```\n<p> [[x]] \\textbf{y}\n```", []),
        "call <code>a<b></code> now": ("call `a<b>` now", ["html"]),
        "see [[Page|the page]] and '''bold'''": ("see the page and bold", ["wiki"]),
        "== Head ==\ntext": ("## Head\ntext", ["wiki"]),
        r"\textbf{x} costs $5 and $y$ is \(a^2\)": (r"x costs $5 and $y$ is $a^2$", ["latex"]),
        "pay $500 now. A ticker $TIDE, quoted at $1.20": ("pay $500 now. A ticker $TIDE, quoted at $1.20", []),
        "if 3 < 5 && a > b; cast<int> x": ("if 3 < 5 && a > b; cast<int> x", []),
        "<table><tr><td>a</td><td>b</td></tr></table>": ("| a | b |", ["html"]),
        "": ("", []),
    }
    assert {k: clean(k) for k in cases} == cases


def test_residue_goes_and_short_paragraphs_stay():
    clean = markup.Cleaner()
    assert clean("One.\n\n<div>\n}}\n</div>\n\n|}\n\nNo\n\n***\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\n}\n\n}\n```")[0] == "One.\n\nNo\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\n}\n\n}\n```"
    assert markup.Cleaner.between_surge_and_dive("a\n\n--\n--\n\nb\n--") == "a\n\nb\n--"


def test_residue_with_letters_goes():
    clean = markup.Cleaner()
    left = "One.\n\n\\documentclass[a4]{article}\n\\usepackage{x}\n\nfee=0\n\n\\begin{tabular}{|l|p{3cm}|}\n\\end{tabular}\n\nwidth=10% class=\"wide\"\n\nNo\n\n    width=10\n\n{l} x\n\n```\n{ll}\n```"
    assert clean(left) == ("One.\n\nfee=0\n\nNo\n\n    width=10\n\n{l} x\n\n```\n{ll}\n```", ["latex"])
    assert clean("The width=10 of `a`\n\nset class=x here")[0] == "The width=10 of `a`\n\nset class=x here"


def test_markup_table(spark):
    df = spark.createDataFrame([(1, "<i>x</i>", "c"), (2, None, "c"), (3, "", "c"), (4, "a" * 200_000, "c")], "id int, text string, clean string")
    got = {r.id: r.markups for r in markup.clean_texts(df, "text").collect()}
    assert got == {1: ["html"], 2: None, 3: [], 4: []}


# 5: overlap


def test_overlap_against_brute_force(spark):
    rng = random.Random(9)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(20, 60))] for _ in range(25)]
    texts = []
    for words in base:
        for _ in range(4):
            w = list(words)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = "z" + str(rng.randrange(99))
            texts.append(" ".join(w))
    texts += [texts[0]] * 5 + ["", "one two", None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, t string, class_id int")
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in (re.findall("[a-z0-9_]+", (t or "").lower()) for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 5 * len(x & sets[j]) > 3 * len(x | sets[j]):
                root[find(i)] = find(j)
    want = {(i, j) for j in range(len(texts)) for i in range(j) if sets[i] and sets[j] and find(i) == find(j)}
    # as it is, in many small shards, and with every list split into blocks
    for sizes in ({}, {"shard_postings": 40}, {"list_postings": 2, "shard_postings": 400}):
        got = overlap.group_pairs(overlap.overlap_groups(df, "id", F.col("t"), **sizes), "id")
        assert {tuple(r) for r in got.collect()} == want
    assert overlap.group_pairs(overlap.overlap_groups(df.where("false"), "id", F.col("t")), "id").count() == 0


def test_meetings_that_cannot_link_stay_in_their_shard(spark):
    """Texts of one small vocabulary meet on many short lists; only pairs that may be linked leave the shard."""
    rng = np.random.default_rng(5)
    lists, n = np.sort(rng.integers(0, 6, 900)) ** 3 // 9, rng.integers(1, 300, 900)
    reach = n * 5 // 3 - rng.integers(0, 200, 900)
    want = {(a, b) for a in range(900) for b in range(900) if lists[a] == lists[b] and (n[a], a) < (n[b], b) and n[b] <= reach[a] and n[a] <= reach[b]}
    got = [(a, b) for x, y in overlap.meetings(lists, n, reach) for a, b in zip(x.tolist(), y.tolist())]
    assert len(set(got)) == len(got) and want <= set(got) and len(got) < 1.3 * len(want)
    rare = " ".join(f"rare{k}" for k in range(40))
    own = [" ".join(f"{chr(97 + t)}{k}" for k in range(150)) for t in range(12)]
    texts = [f"{rare} {x}" for x in own] + [f"{rare} {own[0]} more words here"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    # with no order of runs known, a part of the 38 that all texts share is on short lists
    assert overlap.candidate_pairs(df.select("t"), (np.zeros(1 << 20, np.uint8), 2000)).count() == 1
    assert {tuple(r) for r in overlap.group_pairs(overlap.overlap_groups(df, "id", F.col("t")), "id").collect()} == {(0, 12)}


# 6: survivors


def test_survivors(spark):
    kind = "scvd_id string, duplicate_of string, origin string, severity string, target struct<path:string,contract_name:string>, repo struct<url:string,commit_sha:string>, provenance struct<scvd_normalized_at:string>"
    at = lambda t: (t,)
    rows = [
        ("r", None, "issue", "High", ("src/a.sol", "?"), ("https://x/y", "0000000"), at("2024-01-01T00:00:00Z")),
        ("m", "r", "pdf", "unknown", (None, "B"), (" TBD", "abcdef1"), at("2024-01-01T00:30:00+01:00")),
        ("n", "m", "pdf", "Low", ("n/a", "C"), None, at("2024-01-01T00:00:00-05:00")),
        ("n", "m", "pdf", "Low", ("n/a", "C"), None, at("2024-01-01T00:00:00-05:00")),
        ("x", "y", "native", "High", None, None, at(None)),
        ("y", "x", "native", "High", None, None, at("bad")),
        ("lost", "gone", "native", "High", None, None, at(None)),
        ("alone", None, None, "", None, None, at(None)),
    ]
    findings = spark.createDataFrame(rows, kind)
    long = survivors.finding_members(findings)
    strict = survivors.voted_values(long, "scvd_id", "origin", "normalized_at", half_life_days=0)
    got = {(r.root_id, r.field_name): r.scvd_id for r in strict.collect()}
    assert got == {("r", "repo_url"): "r", ("r", "commit_sha"): "m", ("r", "target_path"): "r", ("r", "contract_name"): "n", ("r", "severity"): "n"}
    votes = survivors.voted_values(long, "scvd_id", "origin", "normalized_at", F.lit("2024-01-02").cast("timestamp"))
    assert survivors.pivoted(votes, ("severity",)).first().severity == "Low"
    assert survivors.finding_members(findings.where("false")).count() == 0


def test_strict_votes_against_sorting(spark):
    rng = random.Random(11)
    rows = [(f"g{rng.randrange(4)}", "f", rng.choice("ABc"), f"k{i:03d}", rng.choice(["native", "pdf", "issue", None]), rng.choice([None, 1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "root_id string, field_name string, value string, k string, origin string, t int")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    order = {"native": 0, "pdf": 1, "issue": 2, None: 3}
    want = {g: min((order[o], -(t or 0), k) for x, _, _, k, o, t in rows if x == g)[2] for g in {r[0] for r in rows}}
    assert {r.root_id: r.k for r in survivors.voted_values(df, "k", "origin", "t", half_life_days=0).collect()} == want


def test_what_counts_as_missing(spark):
    bad = [None, "", " ", "-", "?", "...", "./", "/", "N.A.", "n/a", "(pending)", "TBD", "<path>", "See  report", "Unknown", "<contract name>", "—"]
    good = ["High", "Main", "Head", "src/a.sol", "https://x/y", "<https://x/y>", "QA", "mixed", "日本"]
    rows = spark.createDataFrame([(x,) for x in bad + good], "v string").select("v", survivors.usable(F.col("v")).alias("ok")).collect()
    assert [r.ok for r in rows] == [False] * len(bad) + [True] * len(good)
    links = spark.createDataFrame([("https://",), ("http:",), ("https://x/y",), ("git.example/x",)], "v string")
    assert [r[0] for r in links.select(survivors.is_address(F.col("v"))).collect()] == [False, False, True, True]


# 7: tokens


def test_tokens(spark):
    tiktoken = pytest.importorskip("tiktoken")
    try:
        vocab = tokens.vocabulary(open(tokens.VOCABULARY, "rb").read())
    except OSError:
        pytest.skip("no vocabulary here")
    other = tiktoken.Encoding("x", pat_str=tokens.PIECES, mergeable_ranks=vocab.ranks, special_tokens={})
    texts = ["Hello  world, it's 'll\r\n\r\n ", "日本語 é👨‍👩‍👧 <|endoftext|>", "a" * 3000, " " * 500 + "x", "0x" + "0" * 900, ""]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, None])], "doc_id int, text string, ids int")
    got = {r.doc_id: r.ids for r in tokens.encode_texts(df).collect()}
    assert got == {i: other.encode_ordinary(t) for i, t in enumerate(texts)} | {len(texts): []}
    rng = random.Random(1)
    open_text = tokens.Encoding(vocab, texts[0] * 30)
    for _ in range(60):
        a = rng.randrange(len(open_text.text) + 1)
        open_text.replace(a, min(len(open_text.text), a + rng.randrange(5)), rng.choice(["", "'s", "  ", "é1", "\n"]))
        assert open_text.recomputed < 20
        open_text.append(rng.choice([" a", "b", "\n"]))
        assert open_text.ids() == other.encode_ordinary(open_text.text)
    first = open_text.text[: open_text.starts[1]].encode()
    assert all(open_text.prefix_ids(0, k) == vocab.encode_piece(first[:k]) for k in range(1, len(first) + 1))


# 8: leaks


def passage(seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(500)}" for _ in range(60))


def test_leaks(spark):
    one, two = passage(1), passage(2)
    items = spark.createDataFrame([(1, f"Read.\n\n{one}\n\nWhich?", "t"), (2, f"Say.\n\n{one}\n\nWhat?", "t"), (3, f"Read.\n\n{two}\n\nWhich?", "t"), (4, "no passage", "t"), (5, None, "t")], "item_id int, text string, task string")
    words = one.split()
    edited = [("CHANGED" if k % 7 == 3 else w.upper()) for k, w in enumerate(words)]
    docs = {1: "intro " + one + " end", 2: "**" + "**, ".join(edited[:30]), 3: " ".join(words[:19]), 4: "Read. Which? " + " ".join(words[:10]), 5: " x ".join(two.split()[:4] * 20), 6: " ".join(words[5:26]), 7: None, 8: ""}
    df = spark.createDataFrame([(k, t, 0) for k, t in docs.items()], "doc_id int, text string, item_id int")
    found = leaks.find_leaks(df, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, i) for d in (1, 2, 6) for i in (1, 2)}
    cleaned = {r.doc_id: r.cleaned for r in leaks.remove_leaks(df, found).collect()}
    assert cleaned[1] == "intro  end" and cleaned[3] == docs[3] and cleaned[7] is None
    assert leaks.find_leaks(df, items.where("false")).count() == 0


def test_every_leaked_stretch_goes(spark):
    one = passage(1)
    words, other = one.split(), " ".join(f"x{k}" for k in range(40))
    items = spark.createDataFrame([(1, f"Read.\n\n{one}\n\nWhich?")], "item_id int, text string")
    halves = " ".join(words[:30]), " ".join(words[30:])
    near = " ".join(words[:22]) + " " + " ".join(f"y{k}" for k in range(17)) + " " + " ".join(words[22:44])
    docs = [(1, f"a {halves[0]} {other} {halves[1]} z"), (2, f"a {one} {other} {one} z"), (3, f"a {one} b {one} z"), (4, f"a {near} z"), (5, f"a {' '.join(words[:19])} {other} z")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    found = leaks.find_leaks(df, items)
    cleaned = {r.doc_id: r.cleaned for r in leaks.remove_leaks(df, found).collect()}
    gap = " ".join(f"y{k}" for k in range(17))
    assert cleaned == {1: f"a  {other}  z", 2: f"a  {other}  z", 3: "a  b  z", 4: f"a  {gap}  z", 5: docs[4][1]}


@pytest.mark.parametrize("seed", range(3))
def test_cuts_leave_other_scripts_alone(seed):
    rng = random.Random(seed)
    one = " ".join(rng.choice(["Первый", "абзац", "ξένο", "κείμενο", "café", "naïve", "w"]) + str(rng.randrange(60)) for _ in range(45))
    around = "Ещё\r\nодин «абзац».\r\n", "\r\n\tΤέλος ｆｉｎｅ\u00a0ок\u200b\r\n"
    seen = one.replace("c", "с").replace("é", "e\u0301").upper().replace(" ", "\r\n", 3).replace(" ", " **", 1)
    index = leaks.LeakIndex([(7, one)])
    ((_, item, matched, start, end),) = index([around[0] + seen + around[1]])
    text = around[0] + seen + around[1]
    assert item == 7 and matched == 45 and (text[:start], text[end:]) == around


def test_items_in_blocks_and_words_against_brute_force(spark):
    rng = random.Random(2)
    passages = [passage(s) for s in range(6)]
    items = spark.createDataFrame([(k, f"Read.\n\n{p}\n\nQ?") for k, p in enumerate(passages)], "item_id int, text string")
    docs = []
    for k in range(40):
        words = passages[k % 6].split()[rng.randrange(20) :][: rng.randrange(15, 40)]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = "zz"
        docs.append((k, " ".join(["pad"] * 9 + words + ["end"] * 9)))
    df = spark.createDataFrame(docs, "doc_id int, text string")
    pairs = lambda found: {(r.doc_id, r.item_id) for r in found.collect()}
    whole = pairs(leaks.find_leaks(df, items))
    assert whole == pairs(leaks.find_leaks(df, items, block_bytes=1)) and whole
    index = leaks.LeakIndex([])

    def holds(text, p):
        a, b = (index.words.of([x])[0] for x in (text, p))
        return any(e <= leaks.EDITS * m and m >= 20 for e, m, *_ in (leaks.aligned_stretches([a], [b], c)[0] for c in leaks.COSTS))

    assert whole == {(k, i) for k, t in docs for i, p in enumerate(passages) if holds(t, p)}


# 9: look-alikes


def test_lookalikes(spark):
    form = lookalikes.transducer()
    same = ["Café fine paper", "Cafe\u0301 ﬁne  paper", "Саfé\u00a0ｆine\u200b pa\u00adper ", "\ufeffCafé\r\nfine\tpaper"]
    assert len({form(x) for x in same}) == 1
    different = ["Cafe fine paper", "café fine paper", "Café² fine paper", "Café ② fine paper", "Café2 fine paper", "Caféfine paper"]
    assert len({form(x) for x in [same[0], *different]}) == 7
    assert form("👨\u200d👩") == "👨\u200d👩" and form("a\u200db") == "ab" and form(" \u200b ") == "" and form("ｶﾞ") == "ガ"
    assert all(form(form(x)) == form(x) for x in [*same, *different, "ё Ё ά ﬃ Ⅷ １２"])
    assert form("ｶﾞｷﾟ a\x07\u2800b \u200b c") == "ガキ゚ a b c" and form("\u0435\u0308 \u0451 ë ĳ ǆ") == "ë ë ë ij dž"
    rows = [*enumerate(same), *enumerate(different, 10), (20, same[0]), (30, None), (31, "  "), (32, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("form_id", F.lit(1))
    got = {tuple(r) for r in lookalikes.equal_looking_pairs(df).collect()}
    assert got == {(a, b) for b in range(4) for a in range(b)} | {(1, 20), (2, 20), (3, 20)}


def test_transducer_refuses_conflicts():
    form = lookalikes.Transducer()
    assert {len(k) for k in form.table} >= {1, 2, 3} and all(form(form(k)) == form(k) for k in form.table)
    with pytest.raises(ValueError):
        form.add("а", "o")
    form.add("ж", "а")
    with pytest.raises(ValueError):
        form.check()


def test_copies_of_a_variant_add_no_joins(spark):
    rows = [(k, "fine paper") for k in range(300)] + [(1000, "ﬁne paper"), (1001, "ﬁne  paper"), (1002, None)]
    got = lookalikes.equal_looking_pairs(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {tuple(r) for r in got.collect()} == {(k, v) for k in range(300) for v in (1000, 1001)} | {(1000, 1001)}
    assert lookalikes.equal_looking_pairs(spark.createDataFrame([], "doc_id int, text string")).count() == 0
