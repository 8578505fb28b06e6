import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from metframe.session import local_session
spark = local_session("elsewhere", 4, 4)
for name in {names!r}:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name)
"""
NAMES = ["op4_bpe_tree_concatenation", "op6_log_bilinear_lm", "op7_weak_supervision_toxicity", "op11_threshold_join_negatives", "op13_shared_cut_alignment"]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """From another folder and without a path to the package, workers cannot import it."""
    repo = str(Path(__file__).resolve().parents[2])
    env = {"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)} | {k: v for k, v in __import__("os").environ.items() if k.startswith(("JAVA", "SPARK", "LANG", "LD_")) or k == "PATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, names=NAMES)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert [x for x in out.stdout.splitlines() if x.startswith("done")] == [f"done {n}" for n in NAMES], out.stderr[-2000:]
