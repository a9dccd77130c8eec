"""corpusprep.functions"""
