"""DataFrame operators: chunked ordered scans, time series, samples, joins, ledgers, audits, metrics."""
