import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from keepwell.session import local_session
from keepwell.llm import queries
spark = local_session("8", "shipping")

def worker_lacks_the_package(batches):
    import importlib.util
    assert importlib.util.find_spec("keepwell") is None
    yield from batches

worker_lacks_the_package.__module__ = "__main__"
assert spark.range(1).mapInArrow(worker_lacks_the_package, "id long").count() == 1
for name in sys.argv[3:]:
    assert queries.QUERIES[name](spark, sys.argv[2]).count() > 0, name
    print("done", name)
"""


def test_operators_run_where_workers_lack_the_package(tmp_path, sf_dir):
    from keepwell.llm import queries

    names = [n for n in queries.QUERIES if n.split("_")[0] in {"op2", "op3", "op5", "op7", "op8", "op9", "op11", "op12", "op13"}]
    repository = str(Path(__file__).parents[2])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repository, sf_dir, *names],
        cwd=tmp_path, capture_output=True, text=True, timeout=600, check=False, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"},
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("done op") == len(names) == 9
