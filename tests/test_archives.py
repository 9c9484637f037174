"""Archives whose files have different line ends."""

import gzip

from webfacts.constants import RECORD_MARK
from webfacts.sources.archives import crlf_files, read_chunks, read_warc


def write(path, newline, records):
    data = "".join(f"{RECORD_MARK}\nid: {r}\n\nbody {r}\n\n\n" for r in records)
    opener = gzip.open if path.suffix == ".gz" else open
    with opener(path, "wb") as out:
        out.write(data.replace("\n", newline).encode())


def mixed(folder):
    write(folder / "a.warc.gz", "\n", range(0, 50))
    write(folder / "b b.warc", "\r\n", range(50, 100))
    write(folder / "c.warc.gz", "\r\n", range(100, 150))
    write(folder / "d.warc", "\n", range(150, 200))
    (folder / "e.warc").write_text("no mark at all")
    (folder / "f.warc").write_text("")
    return str(folder)


def test_records_of_mixed_line_ends(spark, tmp_path):
    got = [r["payload"] for r in read_warc(spark, mixed(tmp_path)).filter("payload != ''").collect()]
    assert sorted(got) == sorted([f"id: {i}\n\nbody {i}" for i in range(200)] + ["no mark at all"])


def test_no_file_is_held_whole(spark, tmp_path):
    paths = mixed(tmp_path)
    assert len(crlf_files(spark, paths)) == 2
    longest = max(len(r["value"]) for r in read_chunks(spark, paths).collect())
    assert longest < 60


def test_each_read_opens_its_own_files(spark, tmp_path):
    chunks = read_chunks(spark, mixed(tmp_path))
    chunks.collect()
    leaves = chunks._jdf.queryExecution().executedPlan().collectLeaves()
    files = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
    assert len(files) == 2 and files[0] == 2 and files[1] in (3, 4)


def test_marks_of_both_kinds_in_one_file(spark, tmp_path):
    write(tmp_path / "x", "\n", range(3))
    write(tmp_path / "y", "\r\n", range(3, 10))
    (tmp_path / "z.warc").write_bytes((tmp_path / "x").read_bytes() + (tmp_path / "y").read_bytes())
    got = [r["payload"] for r in read_warc(spark, str(tmp_path / "z.warc")).filter("payload != ''").collect()]
    assert sorted(got) == [f"id: {i}\n\nbody {i}" for i in range(10)]
