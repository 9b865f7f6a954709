"""The registered queries of the corpus operators: ``QUERIES`` by name, ``ORACLE`` with the SQL twins."""

from silverloom.llm.queries import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13

_MODULES = (op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
