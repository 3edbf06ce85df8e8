"""Sketches tell long texts apart that begin alike."""

from tallyspan.operators import drift

START = "/datos/raw/pdf/informes/anuales/consolidados/"


def score(a, b):
    return drift.rename_score("ruta_origen", ["text", drift.sketch(a)], "nota_origen_b", ["text", drift.sketch(b)], drift.Names())


def test_common_beginning_is_no_rename():
    assert drift.name_likeness("ruta_origen", "nota_origen_b") > 0
    a, b = START + "uno.pdf", START + "dos y tres (copia).pdf"
    assert drift.value_likeness(["text", drift.sketch(a)], ["text", drift.sketch(b)]) == 0.2
    assert score(a, b) < drift.RENAMED <= score(a, a)


def test_long_shapes():
    like = lambda a, b: drift.value_likeness(["text", drift.sketch(a)], ["text", drift.sketch(b)])
    assert like("1" * 100, "2" * 100) == 0.8 and like("1" * 100, "2" * 101) == 0.2
    assert all(len(x) <= 64 for x in drift.sketch("1-" * 10_000))
    assert "9" in drift.sketch("1-" * 100)[0] and "9" not in drift.sketch("a-" * 100)[0]
