"""Settings files and the order in which settings are looked for; a state file that cannot be read."""

from trustlake.functions import verify
from trustlake.sources import stores, tables


def test_lines_of_a_settings_file(spark, tmp_path):
    text = "# A=0\r\n\r\nA=1\r\nexport B = ' x y '\r\n\tC='\"z'\r\nD\n=E\nF=a=b\n export  A=\"2\"\nG=\nH=half\"\n"
    (tmp_path / ".env").write_bytes(text.encode())
    got = {r["key"]: r["value"] for r in tables.dotenv(spark, f"{tmp_path}/.env").collect()}
    assert got == {"A": "2", "B": " x y ", "C": "z", "F": "a=b", "G": "", "H": "half"}
    (tmp_path / "none").write_text("")
    assert tables.dotenv(spark, f"{tmp_path}/none").count() == 0
    keys = [("A", "1", "first"), ("B", "", "second")]
    (tmp_path / "made").write_text(stores.rendered_settings(keys, {"B": "x"}))
    assert {r["key"]: r["value"] for r in tables.dotenv(spark, f"{tmp_path}/made").collect()} == {"A": "1", "B": "x"}


def test_settings_from_the_first_source_that_has_them(spark):
    rows = lambda d: spark.createDataFrame(list(d.items()), "key string, value string")
    got = tables.settled(rows({"A": "d", "B": "d", "C": "d", "D": None}), rows({"A": "e", "C": None, "X": "e"}), rows({"A": "f", "B": "f", "C": "f"}))
    assert {r["key"]: r["value"] for r in got.collect()} == {"A": "e", "B": "f", "C": None, "D": None}
    assert {r["key"]: r["value"] for r in tables.settled(rows({"A": "d"})).collect()} == {"A": "d"}


def test_unreadable_state_counts_as_empty(spark, tmp_path):
    hidden = stores.StateFile(spark, f"file://{tmp_path}/.state.json")
    hidden.save({"dead_until": {"a": 5, "b": 9}})
    assert hidden.load(5) == {"dead_until": {"b": 9}}
    state = stores.StateFile(spark, f"file://{tmp_path}/state.json")
    for text in ("", "[1, 2]", "{", "7"):
        (tmp_path / "state.json").write_text(text)
        (tmp_path / ".state.json.crc").unlink(missing_ok=True)
        assert state.load(0) == {"dead_until": {}}


def test_signatures_made_here_hold(spark):
    message = bytes(range(32))
    rows = [(message, *verify.signature(n, message)) for n in (1, 2, verify.N - 1, 12345)]
    assert verify.signatures_hold(rows) == [True] * 4 and rows[0][1] == rows[2][1]
    events = spark.createDataFrame([(3, 5, 1, [["t", "x"]], "a\n"), (4, 6, 1, [], "b")], "secret int, created_at long, kind int, tags array<array<string>>, content string")
    made = verify.with_signatures(events, "secret")
    assert verify.only_verified(made).count() == 2
