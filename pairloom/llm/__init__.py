"""Operations on training text: counting, cleaning, scoring, de-duplicating, encoding and sharding documents."""
