"""Set-based operators over durable-workflow history."""
