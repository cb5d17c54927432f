"""Sources and sinks: input tables, the vector store and the conversation store."""
