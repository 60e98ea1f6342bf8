import duckdb
import pytest

from compare import difference
from marquee.llm.quality_rules import ORACLE, cleaned, quality_rules


def check(docs, tmp_path):
    path = str(tmp_path / "d")
    docs.select("doc_id", "text", "source").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM '{path}/*.parquet'")
    assert difference(quality_rules(docs), con, ORACLE) is None


def test_odd_rows(make_docs, odd_rows, tmp_path):
    check(make_docs(*[r for r in odd_rows if "\x00" not in (r[1] or "")]), tmp_path)


def test_repeats_and_common_lines(make_docs, tmp_path):
    words = [f"w{i}" for i in range(40)]
    rows = [
        (i, "\n".join([" ".join(words[i % 7 : i % 7 + 12]), "Share this  page now", f"line {i} own text here"]), "h1")
        for i in range(30)
    ]
    rows += [(100, "a b c d e a b c d e a b c", "h2"), (101, " ".join(words), None), (102, "x #*$ | <b>\n\n x\nx", "h2")]
    rows += [(200 + i, "menu home about\n" * 3 + "\n".join(words[:3]), "h3") for i in range(12)]
    check(make_docs(*rows), tmp_path)


def test_depleted_document_goes(make_docs):
    shared = "this line stands in every document of the host and says nothing at all"
    rows = [(i, f"{shared}\nown{i}", "h") for i in range(20)]
    rows += [(50 + i, f"{shared}\n" + " ".join(f"own{i}x{k}" for k in range(30)), "h") for i in range(5)]
    kept = {r.doc_id: (r.kept, r.removed_words) for r in quality_rules(make_docs(*rows)).collect()}
    assert not any(kept[i][0] for i in range(20)) and all(kept[50 + i] == (True, 14) for i in range(5))


def test_common_lines_leave_the_text(make_docs):
    shared = "menu  home about\tthis page"
    own = "\n".join(f"own words of one document number {k}" for k in range(4))
    rows = [(i, f" {shared}\n\n{own} {i}\n{shared} \nend {i}\n", "h") for i in range(20)]
    rows += [(100, f"{shared}\n{own}", "other"), (101, None, "h"), (102, f"\n{own} x\n", "h")]
    text = {r.doc_id: r.text for r in cleaned(make_docs(*rows)).collect()}
    rest = own.split("\n")[3]  # with the number of the document behind it
    assert all(text[i] == f"\n{rest} {i}\nend {i}\n" for i in range(20))
    assert text[100] == rows[20][1] and text[101] == "" and text[102] == f"\n{rest} x\n"


def test_empty_table(make_docs):
    assert quality_rules(make_docs((1, "x")).where("false")).count() == 0


@pytest.mark.parametrize("text, covered", [
    ("a b c d e f", 0), ("a a a a a a", 6), ("a b c d e a b c d e", 10), ("a b c d a b c d a b c d", 12),
])
def test_repeated_words(make_docs, text, covered):
    assert quality_rules(make_docs((1, text))).first().n_repeat_words == covered


def test_many_common_lines(make_docs):
    """Texts of common lines only, of such and own ones, and lines that repeat: every line
    stays or goes wherever it stands, and the work grows with the number of lines."""
    common = [f"common line {i}" for i in range(3_000)]
    rows = [(i, "\n".join([*common, f"own {i}", "", *common, f"own {i}", f"  own   {i} again"])) for i in range(12)]
    rows += [(100 + i, "\n".join(common)) for i in range(12)] + [(200, "no common line\n\nat all"), (None, "\n".join(common[:2]))]
    found = {r.doc_id: r for r in cleaned(make_docs(*rows)).collect()}
    for i in range(12):
        assert found[i].text == f"own {i}\n\nown {i}\n  own   {i} again" and found[i].removed_words == 9_000
        assert found[100 + i].text == "" and not found[100 + i].kept
    assert found[200].text == "no common line\n\nat all" and found[None].text == ""
    counted = {r.doc_id: r for r in quality_rules(make_docs(*rows)).collect()}
    assert all(counted[i].removed_words == found[i].removed_words and counted[i].kept == found[i].kept for i in found)
