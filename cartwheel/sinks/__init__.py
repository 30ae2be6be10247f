"""Writers: keyed change logs, date-partition replacement, text and CSV reports."""
