from tallyweave.llm import spam

HEAD = "commit 0a1b\nAuthor: A B <a@b.test>\nDate:   Mon\n\n    Update Home\n\n"


def diff(lines, path="wiki/Home.md", before=()):
    body = "".join(f"-{x}\n" for x in before) + "".join(f"+{x}\n" for x in lines)
    return HEAD + f"diff --git a/{path} b/{path}\n--- a/{path}\n+++ b/{path}\n@@ -0,0 +1,9 @@\n" + body


def test_stuffed():
    kinds = [
        [f"buy {p} {c}ton" for p in ("sofa", "lamp") for c in ("Ka", "Lo", "Mi", "Nu", "Po")] * 2,
        ["Sofa price sofa deal sofa. Sofa cheap sofa best sofa."] * 6,
        ["#buy-sofa #cheap_lamp #saledrone #nearmesofa #top-rated-lamp"] * 6,
        [f"SKU {k}31 | sofa order now | {k}.99 | free shipping" for k in range(12)],
        [f'<li><a href="https://h{k}.test/buy-sofa" rel="dofollow">cheap sofa</a></li>' for k in range(12)],
        [" ".join(f"https://h{k}{j}.test/{k}a{j}f0c" for j in range(4)) for k in range(9)],
        ["ch3ap s0fa 0nl1ne, b3st s0fa d3al, s0fa 0nl1ne c0up0n"] * 6,
        ["ｂｕｙ ѕоfа оnlіnе, cheap sofa deal"] * 8,
        ["Kernel relay kernel index kernel. Kernel index kernel relay kernel."] * 6,
    ]
    for lines in kinds:
        assert spam.is_stuffed(diff(lines)), lines[0]
        assert spam.is_stuffed(diff(["We may want to look at the rest later.", *lines])), lines[0]
        assert spam.is_stuffed(HEAD + "\n".join("    " + x for x in lines)), lines[0]


def test_own_use():
    kinds = {
        "web/package-lock.json": [f'"a-{k}": {{"version": "1.{k}", "resolved": "https://h{k}.test/pkg", "integrity": "sha512-x=="}},' for k in range(12)],
        "site/sitemap.xml": [f"<url><loc>https://h{k}.test/manual/deal</loc></url>" for k in range(12)],
        "docs/tasks.md": [f"- [ ] Fix the relay in the index (https://h{k}.test/x)" for k in range(12)],
        "CHANGES.md": [f"* Fix the cheap path of the index ([#{k}](https://h{k}.test/{k}))" for k in range(12)],
        "mirrors.txt": [f"rsync://h{k}.test/pub/x/" for k in range(12)],
        "shop/pricing.py": ["PRICE['sofa'] = discount(best_price('sofa'), 3)"] * 12,
        "dict/words.txt": [f"word{chr(97 + k)}er" for k in range(26)],
        "docs/shop.md": ["The price of a sofa is read from the cache first, and only then from the store."] * 8,
        "tests/golden.out": ["# fix relay in the index ok (6 ms)"] * 20,
        "CODEOWNERS": [f"/a{k}/b/ @x-team @y-team" for k in range(30)],
    }
    for path, lines in kinds.items():
        assert not spam.is_stuffed(diff(lines, path)), path
    moved = [f"* https://h{k}.test/relay" for k in range(12)]
    assert not spam.is_stuffed(diff([x + "/a1b2c3" for x in moved], "docs/links.md", moved))


def test_edges(spark):
    for text in (None, "", "   ", "\n\n", "buy", "x" * 100_000):
        assert not spam.is_stuffed(text)
    bad = diff(["Sofa price sofa deal sofa. Sofa cheap sofa best sofa."] * 6)
    df = spark.createDataFrame([(1, bad, "c"), (1, bad, "c"), (2, None, "c"), (3, "fine", "c"), (None, bad, "c")], "doc_id long, text string, words string")
    assert [r.doc_id for r in spam.stuffed_pages(df).collect()] == [1]
    assert spam.stuffed_pages(df.limit(0)).count() == 0


def test_recurrence():
    share, peak = spam.recurrence("a b a c a b a c a b".split())
    assert share == 0.5 and peak > 0.8
    assert spam.recurrence([f"w{k}" for k in range(40)]) == (0.0, 0.0)
