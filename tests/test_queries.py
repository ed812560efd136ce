"""Every registered query with SQL, against that SQL, on the smallest tables."""

from __future__ import annotations

import ast
import inspect
from collections import Counter

import pytest

from campaignlens.plans import catalog
from tests.oracle_check import compare, connect

SMALLEST = "/root/testdata/sf0.001"
#: On the smallest tables one median of an even number of rows is an exact half of the last digit shown, which the
#: engines' binary fractions round differently.
LARGER = {name: "/root/testdata/sf0.01" for name in ("profiles_actual_predicted", "profile_file_round_trip")}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    directory = LARGER.get(name, SMALLEST)
    assert compare(catalog.QUERIES[name](spark, directory), connect(directory), catalog.ORACLE[name]) == []


def test_no_name_of_the_catalog_is_assigned_twice():
    """Queries look their constants up when they are called, so a later one of the same name would replace an earlier one."""
    names = Counter()
    for node in ast.parse(inspect.getsource(catalog)).body:
        if isinstance(node, ast.FunctionDef):
            names[node.name] += 1
        elif isinstance(node, ast.Assign):
            names.update(n.id for target in node.targets for n in ast.walk(target) if isinstance(n, ast.Name))
    assert [name for name, times in names.items() if times > 1] == []
