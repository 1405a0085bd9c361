"""A small corpus with every odd case, and the same tables without rows."""

from __future__ import annotations

import random
import re

import pytest

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}
#: Columns that a caller might have and the operators use inside.
EXTRA = ", size long, shard int, node long, n long, key string, n_runs long, text_hash long, kept boolean, `a.b` string"

WORDS = "the of and to in is that for was on with be by as at this".split()
ITEM = "the onely wherin thatof andre shea hinge in retion and was of thenor by ingth eron with thesh"


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) if rng.random() < 0.4 else "".join(rng.choice("aeinorstlh") for _ in range(rng.randint(3, 9))) for _ in range(n)]
    text = " ".join(words)
    return re.sub(r"(\w+ \w+ \w+ \w+ \w+ \w+ \w+) ", r"\1.\n", text, count=n // 40)


def odd_documents() -> list[tuple]:
    rng = random.Random(5)
    passage = prose(rng, 120)
    lines = [prose(rng, 12).replace("\n", " ") for _ in range(9)]
    texts = [prose(rng, n) for n in (1, 3, 4, 5, 6, 20, 60, 90, 200, 400, 700)]
    base = prose(rng, 300).split(" ")
    for edits in (1, 2, 5, 9, 14, 20, 40):
        words = list(base)
        for at in rng.sample(range(len(words)), edits):
            words[at] = f"new{at}"
        texts.append(" ".join(words))
    texts += [" ".join(base)] * 4
    texts += [prose(rng, 50) + " " + passage + " " + prose(rng, 50) for _ in range(3)]
    texts += ["\n".join([prose(rng, 20), *lines, prose(rng, 20)]), "\n".join([*lines[2:], prose(rng, 9)]), "\n".join(lines)]
    texts += ["", " \n\t ", "\n\n\n", "Shti " * 300, "ab" * 700, "x" * 399, "x" * 400, "x" * 401, "é" * 250, "日本語 " * 150]
    texts += ["word " * 4, "Word WORD word word", "a  b\t\tc\x0bd\n\n e", "it's <|endoftext|> 12 a1", "nul \x00 inside", prose(rng, 9000)]
    texts += [prose(rng, 30) + "\n" + ITEM.upper().replace(" ", "  ") + "\n" + prose(rng, 30)]
    texts += ["of%%% the&&& " * 80, "A | table | of | cells | " * 30]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(500, None, "en", "src0", None), (None, "the text without an id", "en", None, 3), (None, None, None, None, None)]
    rows += [(501, texts[9], None, "src1", 1), (502, texts[9], "xx", "src1", 1), rows[9], rows[9], (3, "another text with the same id", "de", "s", 0)]
    return rows


def odd_pages() -> list[tuple]:
    rng = random.Random(6)
    same = "<html><body><article><p>" + prose(rng, 260) + "</p></article></body></html>"
    pages = [f"<html><body><nav><a href=/>Home</a></nav><article><h1>{prose(rng, 4)}</h1><p>{prose(rng, 80)}</p></article></body></html>" for _ in range(6)]
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(pages)]
    rows += [(10, "http://h/ä b\r\nX: y", same), (12, None, same), (11, "u", same), (11, "u", same), (None, "u", same)]
    rows += [(20, "u", "short"), (21, "u", "short"), (22, "u", ""), (23, "u", None), (24, "u", "x" * 1000), (25, "u", "x" * 1000), (26, "u", "x" * 999)]
    rows += [(27, "u", "<p>\r\n\r\nWARC/1.1\r\n</p>" * 200_00), (28, "u", "<div><div>" * 900 + "deep"), (29, "u", "<!-- open"), (30, "u", "<a <b> & &amp; \x00 é")]
    return rows


def write(spark, folder, **tables) -> str:
    for name, schema in TABLES.items():
        rows, extra = tables.get(name, []), EXTRA if name in ("documents", "pages", "conversations") else ""
        width = len(schema.split(", "))
        padded = [tuple(r) + (7, 1, 2, 3, "k", 4, 5, True, "dot") if extra else r for r in rows]
        assert all(len(r) == width for r in rows)
        spark.createDataFrame(padded, schema + extra).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    labels = [(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(0, 40, 2)] + [(None, 1, 1), (2, None, 0), (4, 1, 0), (4, 0, 0), (999, 1, 0)]
    items = [(1, ITEM), (2, ITEM), (2, "another item that no document has in it anywhere at all, really"), (3, None), (None, ITEM), (4, ""), (5, "short")]
    folder = tmp_path_factory.mktemp("odd")
    return write(spark, folder, documents=odd_documents(), labels=labels, pages=odd_pages(), benchmark=items)


@pytest.fixture(scope="session")
def bare(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("bare"))


@pytest.fixture
def save(spark, tmp_path):
    """Writes tables of a test's own and gives their folder."""
    return lambda **tables: write(spark, tmp_path, **tables)
