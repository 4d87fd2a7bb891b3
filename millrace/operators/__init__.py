"""DataFrame operators: change windows, landing, ledger, reports."""
