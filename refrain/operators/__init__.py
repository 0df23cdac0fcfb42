"""DataFrame operators: joins, cleaning, profiles, encoders and data exploration."""
