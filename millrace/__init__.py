"""Event ingestion on PySpark: loosely formatted event files in, trustworthy tables out."""
