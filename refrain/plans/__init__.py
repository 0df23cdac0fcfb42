"""The composite feature pipelines, from raw tables to the wide member table."""
