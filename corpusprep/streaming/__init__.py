"""corpusprep.streaming"""
