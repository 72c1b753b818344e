"""Ready-made queries over the test tables, one module per operator family.

Each module has QUERIES (name -> function of session and folder) and ORACLES
(name -> SQL with the same columns).
"""
