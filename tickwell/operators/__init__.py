"""DataFrame -> DataFrame operators.

Column contract of a tick frame: ``exchange, symbol, ts, data_date, type, price,
volume`` plus ``event_id`` (or another unique column) as the order tie-break.
"""
