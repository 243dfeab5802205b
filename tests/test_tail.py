import os

from plumbline.sources.tail import TailReader, tail
from plumbline.streaming import jobs


def write(path, text, mode="a"):
    with open(path, mode) as f:
        f.write(text)


def test_growing_and_rotating_files_across_restarts(spark, tmp_path):
    logs, out, mark = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "check")
    logs.mkdir()
    app, other = logs / "app.log", logs / "other.log"
    sent = []

    def run():
        jobs.run(tail(spark, str(logs), "*.log*"), out, mark).awaitTermination()
        return sorted(r.line for r in spark.read.parquet(out).collect())

    def say(path, *lines):
        write(path, "".join(f"{x}\n" for x in lines))
        sent.extend(lines)

    say(app, "a1", "a2", "")
    write(other, "unfinished")
    write(logs / "notes.txt", "not a log\n")
    assert run() == sorted(sent)
    say(app, "a3", "é a4")
    write(other, " line\n")
    sent.append("unfinished line")
    assert run() == sorted(sent)
    say(app, "a5")  # not read yet when the file is rotated
    os.rename(app, logs / "app.log.1")
    say(app, "b1", "b2")
    assert run() == sorted(sent)
    say(logs / "app.log.1", "a6")
    say(app, "b3")
    assert run() == sorted(sent)
    write(other, "", "w")  # cut off and written anew
    say(other, "c1")
    assert run() == sorted(sent)
    assert run() == sorted(sent)  # nothing new


def test_large_files_are_cut_into_stretches(tmp_path):
    lines = [f"line {i} " + "x" * (i % 37) for i in range(500)]
    write(tmp_path / "a.log", "\n".join(lines) + "\nrest")
    for size in (1, 7, 64, 1000, 10**6):
        reader = TailReader({"path": f"file://{tmp_path}", "partBytes": str(size)})
        end = reader.latestOffset()
        parts = reader.partitions({}, end)
        read = [r for p in parts for r in reader.read(p)]
        assert [r[3] for r in read] == lines
        assert [r[2] for r in read] == [sum(len(x) + 1 for x in lines[:i]) for i in range(500)]
        assert len(parts) == -(-sum(len(x) + 1 for x in lines) // size)
    (mark, (path, stop)), = end.items()
    half = read[250][2]
    assert [r[3] for p in reader.partitions({mark: [path, half]}, end) for r in reader.read(p)] == lines[250:]
    os.rename(tmp_path / "a.log", tmp_path / "a.log.1")  # renamed between planning and reading
    assert [r[3] for p in parts for r in reader.read(p)] == lines
