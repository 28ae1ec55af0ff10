"""Every global name that a function of the library or the registry reads exists in its module."""

import builtins
import dis
import importlib
import pkgutil
import subprocess
import sys
import types
from pathlib import Path

import pytest

import addrweave
import registry


def modules():
    for package in (addrweave, registry):
        for m in pkgutil.walk_packages(package.__path__, f"{package.__name__}."):
            if not m.ispkg:
                yield m.name


def codes(code):
    yield code
    for c in code.co_consts:
        if isinstance(c, types.CodeType):
            yield from codes(c)


@pytest.mark.parametrize("name", list(modules()))
def test_global_names_exist(name):
    module = importlib.import_module(name)
    with open(module.__file__, encoding="utf-8") as f:
        code = compile(f.read(), module.__file__, "exec")
    missing = {i.argval for c in codes(code) for i in dis.get_instructions(c) if i.opname == "LOAD_GLOBAL" and not hasattr(module, i.argval) and not hasattr(builtins, i.argval)}
    assert not missing


def test_queries_load_without_a_session():
    root = Path(registry.__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=root, check=True, timeout=120)
