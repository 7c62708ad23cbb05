"""Row operators: filters, transforms, cleaning, validation, quality and statistics."""
