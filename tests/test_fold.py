import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.functions.fold import as_read, fold, words


def test_sets_aside_what_a_reader_ignores():
    a = "Đặng Hội  Thuận, the café"
    assert as_read(unicodedata.normalize("NFD", a).upper()) == as_read(a) == "đặng hội thuận the café"
    assert as_read("Ｆｕｌｌ width") == "full width"
    assert as_read("ru­le​s") == "rules"
    assert as_read("Тhе Brоnzе") == as_read("The Bronze")
    assert as_read("ðường") == "đường"
    assert as_read("á̂n") == as_read("ấn")


def test_empty():
    assert fold(None) == "" and words("") == [] and as_read(" ​\n") == ""


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_folding_twice_changes_nothing(t):
    assert as_read(as_read(t)) == as_read(t)


def test_long_text():
    assert len(words("từ " * 200_000)) == 200_000
