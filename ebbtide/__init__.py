"""Bank liquidity analytics as Spark DataFrame operators.

Snapshots of account balances, liquid assets and collateral go through a typed
layer (bronze), a validated and deduplicated layer (silver) and a star schema
(gold).  Every operator takes DataFrames and returns a lazy DataFrame.
"""
