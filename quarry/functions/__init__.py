"""Column expressions: text rules, shapes, ids.  None of them needs Python on the executors."""
