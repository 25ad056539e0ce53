"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random
import re

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "id long, row string, size int, n int, copy string, score double, bucket int, node string, pieces string, parts string, hidden int"
)
EXTRA = (7, "r", 1, 2, "c", 0.5, 3, "n", "p", "q", 4)


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    parts = {
        "en": "the and ing tion er th she wh ou ly", "de": "sch ung keit ver ein der lich ge pf zu",
        "fr": "eau eux ette ou que le la ment tre oi", "es": "cion ado ez que los mente ara illo do ga",
    }[lang].split()
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def rows(seed: int = 1, n: int = 24) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = ("en", "en", "de", "fr", "es")[i % 5]
        out.append((i, prose(rng, rng.randint(60, 120), lang), lang, f"src{i % 3}"))
    copy, base = out[2][1], out[3][1].split()
    out += [(100, copy, "de", "src0"), (101, copy, "de", "src1")]  # exact copies
    out += [(102, " ".join(base[:-2] + ["changed", "end"]), "fr", None)]  # a near copy
    out += [(103, None, None, None), (104, "", "en", "src0"), (105, "   \n\t ", None, "src2"), (106, "1 2 3 !!", "en", "src1")]
    out += [(107, "one two", "en", "src1"), (108, prose(rng, 9000), "en", "src0"), (None, prose(rng, 70), "en", "src9")]
    out += [out[4], out[4]]  # rows that repeat
    out += [(109, "a" * 3000, None, "src2"), (110, "日本語 é ▁ \u0001 x", "xx", "src2")]
    return out


def documents(spark, data: list[tuple] | None = None):
    data = rows() if data is None else data
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in data], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(WORD, text or "")
